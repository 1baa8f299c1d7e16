"""Ranking metrics (M6-M8), distributed.

Rows are first grouped by score (partial aggregation keeps a hot score
cheap); running counts over the distinct scores come from
``cumulative.running_totals``.  AUC uses the rank-sum form with average
ranks over ties; average precision is the step rule over distinct scores
(a tie group enters as one step).  Integer parts are summed exactly as
decimals, so the value does not depend on the partitioning.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensa.operators.cumulative import running_totals
from propensa.operators.rank import score_order


def score_counts(df: DataFrame, score: str, label: str, groups: Sequence[str] = ()) -> DataFrame:
    """(groups..., score, pos, cnt) per distinct non-NULL score."""
    y = F.col(label).cast("int")
    return (df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
            .groupBy(*groups, F.col(score).alias("score"))
            .agg(F.sum(y).cast("bigint").alias("pos"), F.count(F.lit(1)).cast("bigint").alias("cnt")))


def ranking_metrics(df: DataFrame, score: str, label: str, digits: int = 12, groups: Sequence[str] = ()) -> DataFrame:
    """One row per group: ``roc_auc``, ``average_precision``, ``n``, ``positives``, from
    one pass of running totals, low scores first; those from the top are what
    remains of the group's totals."""
    groups = list(groups)
    counts = score_counts(df, score, label, groups)
    d = "decimal(38,0)"
    asc = running_totals(counts, "score", ["pos", "cnt"], groups=groups, totals=True)
    # twice the rank sum of the positives, each at its tie group's average
    # rank: pos * (2 * rows_below + cnt + 1); all integers, summed exactly
    rank_sum2 = F.col("pos").cast(d) * (2 * (F.col("cum_cnt") - F.col("cnt")) + F.col("cnt") + 1).cast(d)
    # rows and positives at or above a score
    pos_above, cnt_above = (F.col(f"all_{m}") - F.col(f"cum_{m}") + F.col(m) for m in ("pos", "cnt"))
    term = F.col("pos").cast("double") * F.try_divide(pos_above.cast("double"), cnt_above.cast("double"))
    tot = asc.groupBy(*groups).agg(F.sum(rank_sum2).alias("rs2"), F.sum(term).alias("s"), F.sum("pos").alias("p"), F.sum("cnt").alias("n"))
    p, n = F.col("p").cast(d), F.col("n").cast(d)
    # undefined (NULL) when a class is missing
    auc = F.try_divide((F.col("rs2") - p * (p + 1)).cast("double"), (2 * p * (n - p)).cast("double"))
    return tot.select(*groups, _round(auc, digits).alias("roc_auc"), _round(F.try_divide(F.col("s"), F.col("p").cast("double")), digits).alias("average_precision"),
                      F.col("n").cast("bigint").alias("n"), F.col("p").cast("bigint").alias("positives"))


def roc_auc(df: DataFrame, score: str, label: str, digits: int = 12, groups: Sequence[str] = ()) -> DataFrame:
    """One row per group: ``roc_auc``, ``n``, ``positives``."""
    return ranking_metrics(df, score, label, digits, groups).drop("average_precision")


def average_precision(df: DataFrame, score: str, label: str, digits: int = 12,
                      groups: Sequence[str] = ()) -> DataFrame:
    """One row per group: ``average_precision`` = sum over distinct scores,
    high to low, of (pos_s / P) * (TP_s / N_s) with TP_s, N_s the running
    counts."""
    return ranking_metrics(df, score, label, digits, groups).select(*groups, "average_precision")


def precision_at_k(df: DataFrame, score: str, label: str, k: int = 80, key: str = "clinician_id",
                   groups: Sequence[str] = ()) -> DataFrame:
    """Label mean over the top-k rows (score desc, key asc), per group.
    Per group the top-k is a ``row_number`` filter, which Spark plans as a
    partial per-partition limit before the shuffle (WindowGroupLimit)."""
    scored = df.filter(F.col(score).isNotNull())
    if groups:
        rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*score_order(score, key)))
        head = scored.withColumn("_rk", rank).filter(F.col("_rk") <= k).groupBy(*groups)
    else:
        head = scored.orderBy(*score_order(score, key)).limit(k)
    return head.agg(
        F.try_divide(F.sum(F.col(label).cast("int")).cast("double"), F.count(F.lit(1)).cast("double"))
        .alias("precision_at_k"),
        F.count(F.lit(1)).cast("bigint").alias("k"))


def _round(c, digits: int):
    """Half-up rounding to ``digits`` places (positive values)."""
    scale = float(10 ** digits)
    return F.floor(c * scale + F.lit(0.5)) / scale
