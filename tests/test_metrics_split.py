"""Ranking metrics against brute force and Spark's evaluator; the split's
determinism and exact per-class counts."""

import math
import random

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from propensa.ml.split import assign_split
from propensa.operators import metrics as M
from propensa.operators.cumulative import running_totals


def _brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def _brute_ap(rows):
    p_total = sum(y for _, y in rows)
    ap, tp, cn = 0.0, 0, 0
    for s in sorted({s for s, _ in rows}, reverse=True):
        grp = [y for x, y in rows if x == s]
        tp += sum(grp)
        cn += len(grp)
        ap += (sum(grp) / p_total) * (tp / cn)
    return ap


def _data(spark, n=400, levels=37, seed=7):
    rnd = random.Random(seed)
    rows = [(i, float(rnd.randrange(levels)), 1 if rnd.random() < 0.3 else 0) for i in range(n)]
    return rows, spark.createDataFrame(rows, "clinician_id int, score double, label int")


def test_auc_matches_brute_force_and_evaluator(spark):
    rows, df = _data(spark)
    got = M.roc_auc(df, "score", "label").collect()[0]
    brute = _brute_auc([(s, y) for _, s, y in rows])
    assert math.isclose(got.roc_auc, brute, abs_tol=1e-11)
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert math.isclose(ev.evaluate(df.withColumn("label", F.col("label").cast("double"))), brute, abs_tol=1e-9)
    assert got.n == 400 and got.positives == sum(y for *_, y in rows)


def test_average_precision_step_rule(spark):
    rows, df = _data(spark, levels=11)
    got = M.average_precision(df, "score", "label").collect()[0][0]
    assert math.isclose(got, _brute_ap([(s, y) for _, s, y in rows]), abs_tol=1e-11)


def test_precision_at_k_tie_break(spark):
    rows = [(i, 1.0, 1 if i < 3 else 0) for i in range(10)]
    df = spark.createDataFrame(rows, "clinician_id int, score double, label int")
    got = M.precision_at_k(df, "score", "label", k=4).collect()[0]
    assert got.precision_at_k == 0.75 and got.k == 4


def test_running_totals_exact_for_any_range_count(spark):
    rnd = random.Random(3)
    rows = [(float(i) + rnd.random(), rnd.randrange(5)) for i in range(300)]
    df = spark.createDataFrame(rows, "k double, m bigint")
    for ranges in (1, 4, 64):
        got = {r.k: r.cum_m for r in running_totals(df, "k", ["m"], descending=False, ranges=ranges).collect()}
        acc = 0
        for k, m in sorted(rows):
            acc += m
            assert got[k] == acc
        got = {r.k: r.cum_m for r in running_totals(df, "k", ["m"], descending=True, ranges=ranges).collect()}
        acc = 0
        for k, m in sorted(rows, reverse=True):
            acc += m
            assert got[k] == acc


def test_split_is_deterministic_and_stratified(spark):
    df = spark.range(1000).select(F.col("id").alias("clinician_id"),
                                  (F.col("id") % 7 == 0).cast("int").alias("label"))
    a = {r.clinician_id: r.split for r in assign_split(df).collect()}
    b = {r.clinician_id: r.split for r in assign_split(df.repartition(5)).collect()}
    assert a == b
    for label, n in ((1, 143), (0, 857)):
        ids = [i for i in range(1000) if (i % 7 == 0) == (label == 1)]
        test = sum(1 for i in ids if a[i] == "test")
        assert test == math.ceil(n * 0.2)


def test_single_class_metrics_are_null_not_errors(spark):
    df = spark.createDataFrame([(1, 0.5, 0), (2, 0.7, 0)], "clinician_id int, score double, label int")
    assert M.roc_auc(df, "score", "label").collect()[0].roc_auc is None
    assert M.average_precision(df, "score", "label").collect()[0][0] is None
    assert M.precision_at_k(df.filter("score > 1"), "score", "label").collect()[0].precision_at_k is None


def test_grouped_metrics_match_per_group(spark):
    rows, df = _data(spark, n=600, levels=23, seed=5)
    df = df.withColumn("g", (F.col("clinician_id") % 3).cast("string"))
    auc = {r.g: r.roc_auc for r in M.roc_auc(df, "score", "label", groups=["g"]).collect()}
    ap = {r.g: r.average_precision for r in M.average_precision(df, "score", "label", groups=["g"]).collect()}
    pk = {r.g: r.precision_at_k for r in M.precision_at_k(df, "score", "label", k=40, groups=["g"]).collect()}
    for g in ("0", "1", "2"):
        part = [(s, y) for i, s, y in rows if str(i % 3) == g]
        assert math.isclose(auc[g], _brute_auc(part), abs_tol=1e-11)
        assert math.isclose(ap[g], _brute_ap(part), abs_tol=1e-11)
        top = sorted([(-s, i, y) for i, s, y in rows if str(i % 3) == g])[:40]
        assert pk[g] == sum(y for *_, y in top) / 40


def test_split_counts_for_many_class_sizes(spark):
    sizes = [1, 2, 3, 5, 9, 10, 11, 15, 49, 50, 51, 333]
    rows, cid = [], 0
    for label, n in enumerate(sizes):
        for _ in range(n):
            rows.append((cid, label))
            cid += 1
    df = spark.createDataFrame(rows, "clinician_id long, label int")
    got = assign_split(df).groupBy("label", "split").count().collect()
    counts = {(r.label, r.split): r["count"] for r in got}
    from decimal import ROUND_CEILING, Decimal

    def ceil(x):
        return int(x.to_integral_value(rounding=ROUND_CEILING))
    for label, n in enumerate(sizes):
        t = ceil(n * Decimal("0.2"))
        c = ceil((n - t) * Decimal("0.2"))
        v = ceil((n - t - c) * Decimal("0.1"))
        want = {"test": t, "calibration": c, "validation": v, "train": n - t - c - v}
        for part, k in want.items():
            assert counts.get((label, part), 0) == k, (label, part)


def test_positions_follow_the_sorted_output(spark):
    from propensa.operators.rank import sorted_by_score, with_position
    rnd = random.Random(1)
    rows = [(i, rnd.choice([None, 1.0, 2.0, 3.0])) for i in range(500)]
    df = spark.createDataFrame(rows, "clinician_id int, s double").repartition(7)
    got = {r.clinician_id: r.position for r in with_position(sorted_by_score(df, "s")).collect()}
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert [got[i] for i, _ in want] == list(range(1, 501))
    assert with_position(sorted_by_score(df.filter("s > 5"), "s")).count() == 0


def test_running_totals_ranges_follow_the_rows(spark, monkeypatch):
    from propensa.operators import cumulative
    df = spark.range(1000).select(F.col("id").cast("double").alias("k"), F.lit(1).cast("bigint").alias("m"))
    monkeypatch.setattr(cumulative, "ROWS_PER_RANGE", 90)
    got = {r.k: r.cum_m for r in running_totals(df, "k", ["m"]).collect()}
    assert got == {float(i): i + 1 for i in range(1000)}
    assert running_totals(df.filter("k < 0"), "k", ["m"]).count() == 0


def test_ranges_of_the_split_follow_the_rows(spark):
    from propensa.ml.split import ROWS_PER_RANGE, range_digits
    assert [range_digits(n) for n in (0, 1, ROWS_PER_RANGE * 16, ROWS_PER_RANGE * 16 + 1, 10**10)] == [1, 1, 1, 2, 5]
    assert all(n / 16 ** range_digits(n) <= ROWS_PER_RANGE < n / 16 ** (range_digits(n) - 1) for n in (10**7, 10**9, 10**12))
    df = spark.range(3000).select(F.col("id").alias("clinician_id"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    got = [sorted(map(tuple, assign_split(df, prefix_len=n).collect())) for n in (None, 1, 2, 4)]
    assert got[0] == got[1] == got[2] == got[3]
