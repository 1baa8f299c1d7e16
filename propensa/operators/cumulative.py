"""Running totals over a global order without a single-partition window.

A window with ``orderBy`` and no ``partitionBy`` moves every row into one
task.  Here the ordered key is cut into ranges first (range bounds from
``approxQuantile``; their number follows from the rows), each range gets
the totals of all ranges before it from a small per-range aggregate (one
row per range), and the running sum inside a range is an ordinary window partitioned by the range.
The bounds only steer balance; the result is exact whatever they are.
The input is usually already grouped by the key (one row per distinct
score), so the checkpoint it is written to is small.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANGE = "_range"

#: Rows of a range, on average; a range is one window group.
ROWS_PER_RANGE = 100_000


def _range_bounds(df: DataFrame, key: str, ranges: int) -> list[float]:
    probs = [i / ranges for i in range(1, ranges)]
    qs = df.approxQuantile(key, probs, min(1e-3, 0.25 / ranges)) if ranges > 1 else []
    inner = sorted({float(q) for q in qs})
    if not inner:
        inner = [0.0]
    return [float("-inf"), *inner, float("inf")]


def running_totals(df: DataFrame, key: str, measures: Sequence[str], descending: bool = False,
                   ranges: int | None = None, prefix: str = "cum_", groups: Sequence[str] = (), totals: bool = False) -> DataFrame:
    """Adds ``cum_<m>`` = sum of ``m`` over all rows at or before this row's
    ``key`` in the chosen direction (within each of ``groups``).  ``key``
    must be unique per row and group (run it on a table already grouped by
    the key) and numeric.  ``groups`` are low-cardinality segment columns
    (e.g. a split): the offset table holds groups x ranges rows.  ``ranges``
    defaults to one per ``ROWS_PER_RANGE`` rows; the result is the same for any
    number.  With ``totals`` also ``all_<m>``, the sum over the whole group."""
    groups = list(groups)
    # the range bounds need one pass over the input and the totals another:
    # checkpoint it (shared folder) so the upstream plan runs only once
    df = df.checkpoint(eager=True)
    bounds = _range_bounds(df, key, ranges or -(-df.count() // ROWS_PER_RANGE))
    keyed = df.withColumn("_k", F.col(key).cast("double"))
    bucketed = Bucketizer(splits=bounds, inputCol="_k", outputCol=_RANGE, handleInvalid="keep").transform(keyed)
    bucketed = bucketed.withColumn(_RANGE, F.col(_RANGE).cast("int"))
    if descending:
        bucketed = bucketed.withColumn(_RANGE, F.lit(len(bounds)) - F.col(_RANGE))

    per_range = bucketed.groupBy(*groups, _RANGE).agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
    # at most groups x len(bounds) rows: the window below runs on that small table
    before = Window.partitionBy(*groups).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(*groups, _RANGE, *[
        F.coalesce(F.sum(f"_t_{m}").over(before), F.lit(0)).alias(f"_o_{m}") for m in measures], *[
        F.sum(f"_t_{m}").over(Window.partitionBy(*groups)).alias(f"all_{m}") for m in measures if totals])

    order = F.col(key).desc() if descending else F.col(key).asc()
    within = (Window.partitionBy(*groups, _RANGE).orderBy(order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # Spark's size check decides whether the offsets are broadcast
    joined = bucketed.join(offsets, [*groups, _RANGE], "left")
    return joined.select(
        *df.columns,
        *[(F.col(f"_o_{m}") + F.sum(m).over(within)).alias(f"{prefix}{m}") for m in measures],
        *[f"all_{m}" for m in measures if totals],
    )
