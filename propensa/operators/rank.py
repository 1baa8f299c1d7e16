"""Ranking and top-k.

A top-k is ``orderBy(...).limit(k)``: Spark plans it as
``TakeOrderedAndProject``, where every partition keeps only its own k best
rows, so no task ever holds more than k rows per input partition.  The
positional rank is then numbered over those k rows only.  A ranking window
over the whole table (which would pull every row into one partition) is
never built.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensa.session import shared_dir


def score_order(score: str, key: str = "clinician_id") -> list[Column]:
    """Score descending with NULLs last, ties broken by the key ascending
    so the k-th place is deterministic."""
    return [F.desc_nulls_last(score), F.asc_nulls_last(key)]


def top_k(df: DataFrame, k: int, order: Sequence[Column], rank_col: str | None = "rank") -> DataFrame:
    """The first ``k`` rows under ``order``; with ``rank_col`` they get the
    1-based position (``row_number``) in that order and come out sorted by it."""
    head = df.orderBy(*order).limit(k)
    if rank_col is None:
        return head
    # the window runs on at most k rows
    return head.withColumn(rank_col, F.row_number().over(Window.orderBy(*order))).orderBy(rank_col)


def sorted_by_score(df: DataFrame, score: str, key: str = "clinician_id") -> DataFrame:
    """Full sort (O1).  A global order costs a range shuffle and is not a
    property a written table keeps, so it is applied at read time."""
    return df.orderBy(*score_order(score, key))


def with_position(ordered: DataFrame, name: str = "position") -> DataFrame:
    """The 1-based place of each row in the output of a sorted frame: its place
    within its output partition plus the rows of the partitions before.  The
    only unpartitioned window runs on one row per output partition."""
    shared_dir(ordered.sparkSession)
    placed = ordered.withColumn("_place", F.monotonically_increasing_id()).checkpoint(eager=True)
    # the id holds the partition number above bit 33 and the place within it below
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(offsets, "_part").select(*ordered.columns, (F.col("_before") + place + 1).cast("bigint").alias(name))
