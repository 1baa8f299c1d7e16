"""Boundary tables for the scoring operators: both sides of each threshold
and NULL."""

from decimal import Decimal

from pyspark.sql import functions as F

from propensa import rules
from propensa.functions import scoring as S
from propensa.functions.scalar import round_half_up
from propensa.plans import models


def test_recency_buckets(spark):
    days = [2, 3, 7, 8, 14, 15, 30, 31, 60, 61, None]
    df = spark.createDataFrame([(d,) for d in days], "d bigint")
    got = [r[0] for r in df.select(S.bucket_score("d")).collect()]
    assert got == [100, 85, 85, 65, 65, 40, 40, 20, 20, 0, 0]


def test_engagement_tier_edges(spark):
    rows = [(5, 3, 1), (5, 3, 0), (5, 2, 0), (5, 1, 0), (5, 0, 1), (3, 9, 9), (2, 0, 0), (1, 0, 0), (0, 9, 9),
            (None, None, None)]
    df = spark.createDataFrame(rows, "l bigint, i bigint, a bigint")
    got = [r[0] for r in df.select(S.engagement_tier("l", "i", "a")).collect()]
    assert got == ["Champion", "Power User", "Power User", "Active", "Power User", "Active", "Casual", "Casual",
                   "Dormant", "Dormant"]


def test_caps_and_null_skipping_least(spark):
    df = spark.createDataFrame([(9,), (10,), (11,), (None,)], "l bigint")
    assert [r[0] for r in df.select(S.capped_linear("l")).collect()] == [90, 100, 100, 100]
    feats = spark.createDataFrame([(0, 0, 0), (0, 0, 1), (0, 0, 12), (9, 1, 12)], "i bigint, a bigint, f bigint")
    got = [r[0] for r in feats.select(S.expansion_score("i", "a", "f")).collect()]
    assert got == [-5, 0, 55, 100]  # no lower clamp


def test_volume_score_edges(spark):
    df = spark.createDataFrame([(None,), (0,), (1,), (128000,), (129000,)], "v bigint")
    got = [r[0] for r in df.select(S.log_score("v")).collect()]
    assert got[0] == 0.0 and got[1] == 0.0 and got[2] == 0.0
    assert 99.9 < got[3] < 100.0 and got[4] == 100.0


def test_lookup_defaults(spark):
    vals = list(rules.EHR_MATURITY_SCORES) + ["Unknown EHR", None]
    df = spark.createDataFrame([(v,) for v in vals], "e string")
    got = [r[0] for r in df.select(S.lookup_score("e", rules.EHR_MATURITY_SCORES, rules.EHR_MATURITY_DEFAULT)).collect()]
    assert got == list(rules.EHR_MATURITY_SCORES.values()) + [30, 30]
    # 'None' is a category, not a null
    assert got[vals.index("None")] == 18


def test_round_half_up_matches_sql_engine_at_binary_ties(spark):
    import duckdb
    xs = [1.005, 2.675, -1.005, 0.125, -2.675, 94.165, 10.5, 33.335]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    want = [duckdb.execute(f"SELECT round(CAST({x!r} AS DOUBLE), 2)").fetchone()[0] for x in xs]
    assert got == want
    # Spark's own round() differs at 1.005 (it rounds the decimal text)
    assert df.select(F.round("x", 2)).first()[0] == 1.01 and got[0] == 1.0


def test_flags_null_to_false(spark):
    df = spark.createDataFrame([(3, 1, 31), (3, 0, 30), (None, None, None)], "i bigint, a bigint, d bigint")
    got = df.select(S.power_user_flag("i", "a"), S.at_risk_flag("d")).collect()
    assert [tuple(r) for r in got] == [(True, True), (False, False), (False, False)]


def test_eligibility_edges(spark):
    rows = [(1, False, 60, 14), (2, False, 61, 14), (3, False, None, 30), (4, False, 10, 13),
            (5, True, 10, 30), (6, None, 10, 30), (7, False, 0, 900)]
    df = spark.createDataFrame(rows, "clinician_id int, converted_to_enterprise boolean, "
                                     "days_since_last_login int, days_on_platform int")
    got = sorted(r[0] for r in models.eligible(df).select("clinician_id").collect())
    assert got == [1, 7]


def test_sales_angle_rules(spark):
    rows = [(1, 9, 9, 9, "Solo"), (0, 5, 9, 9, "Solo"), (0, 4, 8, 9, "Solo"), (0, 4, 7, 7, "Solo"),
            (0, 4, 7, 6, "Large (51-200)"), (0, 4, 7, 6, "Enterprise (200+)"), (0, 4, 7, 6, "Solo")]
    df = spark.createDataFrame(rows, "api_calls_per_week int, team_members_invited int, features_used_count int, "
                                     "logins_per_week int, practice_size string")
    got = [r[0] for r in df.select(S.sales_angle()).collect()]
    t = rules.SALES_ANGLES
    assert got == [t[0], t[1], t[2], t[3], t[4], t[4], t[5]]


def test_weighted_sum_is_exact_decimal(spark):
    df = spark.createDataFrame([(100, 100, 100)], "expansion_score int, frequency_score int, recency_score int")
    out = df.select(S.behavioral_score().alias("b"))
    assert out.schema["b"].dataType.typeName() == "decimal"
    assert out.collect()[0][0] == Decimal("100.00")


def test_top_k_ties_are_broken_by_key(spark):
    from propensa.operators.rank import score_order, top_k
    df = spark.range(100).select(F.col("id").alias("clinician_id"), F.lit(50.0).alias("s"))
    got = top_k(df, 80, score_order("s"), "rank").orderBy("rank").collect()
    assert [r.clinician_id for r in got] == list(range(80))
    assert [r.rank for r in got] == list(range(1, 81))


def test_round_half_up_parity_on_many_ties(spark):
    """Random values with a third decimal of 5 (decimal ties): the Spark
    helper and the SQL engine's round agree on every one."""
    import random

    import duckdb
    rnd = random.Random(11)
    xs = [round(rnd.uniform(-130, 130), 2) + (0.005 if rnd.random() < 0.5 else -0.005) for _ in range(2000)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    got = {r.i: r.y for r in df.select("i", round_half_up("x", 2).alias("y")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(xs)))
    want = dict(con.execute("SELECT i, round(x, 2) FROM t").fetchall())
    assert got == want


def test_wall_clock_stamps(spark):
    import datetime as dt
    rows = [(1, False, 5, 30, 50.0)]
    df = spark.createDataFrame(rows, "clinician_id int, converted_to_enterprise boolean, "
                                     "days_since_last_login int, days_on_platform int, s double")
    stamped = df.select("*", models._stamp(None).alias("scored_at"), models._date(None).alias("d"))
    r = stamped.collect()[0]
    assert dict(stamped.dtypes)["scored_at"] == "timestamp_ntz" and r.scored_at is not None
    assert abs((r.d - dt.date.today()).days) <= 1
    fixed = df.select(models._stamp(dt.date(2001, 8, 2)).alias("t")).collect()[0].t
    assert fixed == dt.datetime(2001, 8, 2)
