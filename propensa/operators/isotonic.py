"""Isotonic regression over any number of points, in two levels (M4).

Points are grouped by score first.  Neighbouring points whose means do not rise are
pooled (pool adjacent violators), range of scores by range of scores, on the
executors; the result of a range is its blocks.  Then the ranges are cut anew, from
the blocks that are left and with borders elsewhere, and so on until the means rise
across all borders.  Pooling parts first does not change the result: the blocks of
a part are unions of its points within a block of the whole.

Every round has as many ranges as the blocks left ask for, ``BLOCKS_PER_RANGE`` a
range; noisy labels leave few blocks, so the second round is mostly the last.  What
reaches the driver is one row for each range (first and last mean), never a point.
Sums are exact decimals and whole numbers, compared by cross products, so the blocks
do not depend on the ranges.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS_PER_RANGE = 100_000
BLOCK = "low double, high double, pos long, cnt long"


def pool(blocks: Iterable[tuple[float, float, int, int]]) -> list[tuple[float, float, int, int]]:
    """Blocks (low, high, pos, cnt), ascending and apart, with violators pooled."""
    out: list[tuple[float, float, int, int]] = []
    for low, high, pos, cnt in blocks:
        while out and out[-1][2] * cnt >= pos * out[-1][3]:
            before = out.pop()
            low, pos, cnt = before[0], before[2] + pos, before[3] + cnt
        out.append((low, high, pos, cnt))
    return out


def _pool_range(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("low")
    found = pool(zip(part["low"].tolist(), part["high"].tolist(), part["pos"].tolist(), part["cnt"].tolist()))
    return pd.DataFrame(found, columns=["low", "high", "pos", "cnt"])


def _borders(blocks: DataFrame, ranges: int, shift: float) -> list[float]:
    probs = [(i + shift) / ranges for i in range(ranges + 1)]
    inner = blocks.approxQuantile("low", [p for p in probs if 0 < p < 1], min(1e-3, 0.1 / ranges)) if ranges > 1 else []
    inner = sorted(set(inner or [])) or [0.0]
    return [float("-inf"), *inner, float("inf")]


def rising(edges: list[tuple[float, int, int, int, int]]) -> bool:
    """Whether means rise across the borders of ranges (low, first pos, first cnt, last pos, last cnt)."""
    edges = sorted(edges)
    return all(a[3] * b[2] < b[1] * a[4] for a, b in zip(edges, edges[1:]))


def isotonic_blocks(points: DataFrame, blocks_per_range: int = BLOCKS_PER_RANGE) -> DataFrame:
    """Blocks (low, high, pos, cnt) of the rising step function closest to ``points``
    (score, pos, cnt: label sum and number of rows of a distinct score); the
    regression's value from score low to high is pos / cnt."""
    score = F.col("score").cast("double")
    blocks = points.select(score.alias("low"), score.alias("high"), F.col("pos").cast("long").alias("pos"), F.col("cnt").cast("long").alias("cnt"))
    blocks = blocks.checkpoint(eager=True)
    turn = 0
    while True:
        n = blocks.count()
        ranges = max(1, -(-n // blocks_per_range))
        cut = Bucketizer(splits=_borders(blocks, ranges, 0.5 * (turn % 2)), inputCol="low", outputCol="cut", handleInvalid="keep")
        one = F.lit(0.0) if ranges == 1 else F.col("cut")
        blocks = cut.transform(blocks).withColumn("cut", one).groupBy("cut").applyInPandas(lambda cut, part: _pool_range(part).assign(cut=cut[0]), BLOCK + ", cut double")
        blocks = blocks.checkpoint(eager=True)
        edges = blocks.groupBy("cut").agg(F.min("low").alias("low"), F.min_by(F.struct("pos", "cnt"), "low").alias("a"), F.max_by(F.struct("pos", "cnt"), "low").alias("b")).collect()
        blocks = blocks.drop("cut")
        if ranges == 1 or rising([(e.low, e.a.pos, e.a.cnt, e.b.pos, e.b.cnt) for e in edges]):
            return blocks
        turn += 1


def isotonic_model(blocks: DataFrame, features: str, output: str, feature: Callable[[Column], Column] = lambda score: score,
                   index: int = 0) -> IsotonicRegressionModel:
    """Spark's model of the step function of ``blocks``.  It is made of the blocks' borders
    only, which rise already; between two blocks it interpolates.  ``feature`` makes
    the ``features`` column of a score (itself, or a vector with it at ``index``)."""
    mean, half = F.col("pos") / F.col("cnt"), F.col("cnt") / 2
    ends = blocks.select(F.explode(F.array(*[F.struct(F.col(c).alias("score"), mean.alias("label"), half.alias("weight")) for c in ("low", "high")])).alias("e")).select("e.*")
    ends = ends.groupBy("score", "label").agg(F.sum("weight").alias("weight"))  # a block of one score has one border
    return IsotonicRegression(featuresCol=features, featureIndex=index, labelCol="label", weightCol="weight", predictionCol=output,
                              isotonic=True).fit(ends.select(feature(F.col("score")).alias(features), "label", "weight"))
