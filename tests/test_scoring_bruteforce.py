"""The scoring chain against a plain-Python scorer written from the rules,
on random rows with NULLs (independent of the SQL oracle)."""

import math
import random
from decimal import ROUND_HALF_UP, Decimal

from propensa import rules
from propensa.functions import scoring as S


def _least(*xs):
    xs = [x for x in xs if x is not None]
    return min(xs) if xs else None


def _greatest(*xs):
    xs = [x for x in xs if x is not None]
    return max(xs) if xs else None


def _recency(d):
    if d is None:
        return 0
    for bound, pts in [(2, 100), (7, 85), (14, 65), (30, 40), (60, 20)]:
        if d <= bound:
            return pts
    return 0


def _tier(lg, inv, api):
    def gt(a, b):
        return a is not None and a > b

    def ge(a, b):
        return a is not None and a >= b
    if gt(api, 0) and ge(inv, 3) and ge(lg, 5):
        return "Champion"
    if ge(lg, 5) and (ge(inv, 2) or gt(api, 0)):
        return "Power User"
    if ge(lg, 3):
        return "Active"
    if ge(lg, 1):
        return "Casual"
    return "Dormant"


def _round2(x):
    if x is None:
        return None
    return math.copysign(1.0, x) * math.floor(abs(x) * 100 + 0.5) / 100 if x != 0 else 0.0


def _row(rnd):
    pick = lambda xs: rnd.choice(xs)
    return dict(
        clinician_id=rnd.randrange(10**9),
        logins=pick([None, 0, 1, 2, 3, 4, 5, 7, 9, 10, 11, 40]),
        idle=pick([None, 0, 2, 3, 7, 8, 14, 15, 30, 31, 60, 61, 200]),
        invites=pick([None, 0, 1, 2, 3, 5, 9]),
        api=pick([None, 0, 180, 360]),
        features=pick([None, 0, 1, 6, 8, 12]),
        size=pick([None, "Unmapped"] + rules.PRACTICE_SIZES),
        ehr=pick([None, "Unmapped"] + list(rules.EHR_MATURITY_SCORES)),
        specialty=pick([None, "Unmapped"] + list(rules.SPECIALTY_NEED_SCORES)),
        volume=pick([None, 0, 1, 50, 999, 128000, 129000, 5_000_000]),
    )


def test_chain_matches_python_scorer(spark):
    rnd = random.Random(2024)
    rows = [_row(rnd) for _ in range(600)]
    schema = ("clinician_id long, logins long, idle long, invites long, api long, features long, "
              "size string, ehr string, specialty string, volume long")
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    scored = df.select(
        "clinician_id",
        S.bucket_score("idle").alias("recency_score"),
        S.capped_linear("logins").alias("frequency_score"),
        S.expansion_score("invites", "api", "features").alias("expansion_score"),
        S.engagement_tier("logins", "invites", "api").alias("tier"),
        S.lookup_score("size", rules.PRACTICE_SIZE_SCORES, rules.PRACTICE_SIZE_DEFAULT).alias("practice_size_score"),
        S.lookup_score("ehr", rules.EHR_MATURITY_SCORES, rules.EHR_MATURITY_DEFAULT).alias("ehr_maturity_score"),
        S.lookup_score("specialty", rules.SPECIALTY_NEED_SCORES, rules.SPECIALTY_NEED_DEFAULT)
        .alias("specialty_need_score"),
        S.log_score("volume").alias("patient_volume_score"),
        S.power_user_flag("invites", "api").alias("is_power_user"),
        S.at_risk_flag("idle").alias("is_at_risk"),
    )
    scored = scored.select("*", S.firmographic_score().alias("firmographic_score"),
                           S.behavioral_score().alias("behavioral_score"))
    scored = scored.select("*", S.baseline_score().alias("baseline"))
    got = {r.clinician_id: r for r in scored.collect()}

    for r in rows:
        g = got[r["clinician_id"]]
        rec = _recency(r["idle"])
        freq = _least(100, None if r["logins"] is None else r["logins"] * 10)
        terms = None
        if r["invites"] is not None and r["features"] is not None:
            terms = r["invites"] * 12 + (28 if (r["api"] or 0) > 0 else 0) + (r["features"] - 1) * 5
        exp = _least(100, terms)
        assert (g.recency_score, g.frequency_score, g.expansion_score) == (rec, freq, exp)
        assert g.tier == _tier(r["logins"], r["invites"], r["api"])
        ps = rules.PRACTICE_SIZE_SCORES.get(r["size"], rules.PRACTICE_SIZE_DEFAULT)
        eh = rules.EHR_MATURITY_SCORES.get(r["ehr"], rules.EHR_MATURITY_DEFAULT)
        sp = rules.SPECIALTY_NEED_SCORES.get(r["specialty"], rules.SPECIALTY_NEED_DEFAULT)
        assert (g.practice_size_score, g.ehr_maturity_score, g.specialty_need_score) == (ps, eh, sp)
        vol = _least(100.0, math.log(_greatest(r["volume"], 1)) * 8.5)
        assert math.isclose(g.patient_volume_score, vol, rel_tol=1e-12, abs_tol=1e-12)
        firmo = _round2(float(Decimal(ps) * Decimal("0.32") + Decimal(eh) * Decimal("0.22")
                              + Decimal(sp) * Decimal("0.26")) + vol * 0.20)
        assert math.isclose(g.firmographic_score, firmo, abs_tol=1e-9)
        power = (r["invites"] is not None and r["invites"] >= 3) and (r["api"] is not None and r["api"] > 0)
        risk = r["idle"] is not None and r["idle"] > 30
        assert (g.is_power_user, g.is_at_risk) == (power, risk)
        if None in (exp, freq):
            assert g.behavioral_score is None and g.baseline is None
            continue
        beh = (Decimal(exp) * Decimal("0.42") + Decimal(freq) * Decimal("0.30")
               + Decimal(rec) * Decimal("0.28")).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert g.behavioral_score == beh
        base = _round2(float(beh * Decimal("0.45")) + g.firmographic_score * 0.42
                       + (13.0 if power else 0.0) - (8.0 if risk else 0.0))
        assert math.isclose(g.baseline, base, abs_tol=1e-9)


def test_sales_angle_matches_python_router(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.choice([None, 0, 180]), rnd.choice([None, 0, 4, 5, 9]), rnd.choice([None, 1, 7, 8]),
             rnd.choice([None, 3, 6, 7]), rnd.choice([None, "Solo"] + rules.LARGE_PRACTICES)) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, api_calls_per_week int, team_members_invited int, "
                                     "features_used_count int, logins_per_week int, practice_size string")
    got = {r.i: r.a for r in df.select("i", S.sales_angle().alias("a")).collect()}
    t = rules.SALES_ANGLES
    for i, api, inv, feat, lg, size in rows:
        if api is not None and api > 0:
            want = t[0]
        elif inv is not None and inv >= 5:
            want = t[1]
        elif feat is not None and feat >= 8:
            want = t[2]
        elif lg is not None and lg >= 7:
            want = t[3]
        elif size in rules.LARGE_PRACTICES:
            want = t[4]
        else:
            want = t[5]
        assert got[i] == want
