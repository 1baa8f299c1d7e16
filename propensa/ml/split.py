"""Deterministic stratified split (M2).

Each row gets ``h = md5("<seed>:<id>")``.  Within each label class the rows
are ordered by ``(h, id)``; the first ``ceil(test * n_c)`` go to test, the
next ``ceil(calibration * rest)`` to calibration, the next
``ceil(validation * rest)`` to validation (early stopping), the remainder
to train.  The assignment depends only on seed and id, never on the
partitioning, and per-class counts are exact.

The rank is computed without a per-class window over the whole class (a
class can hold most rows): the first hex digits of ``h`` cut each class into
ordered ranges of near-equal size, the (class, range) counts give each range
its offset, and the row number is only computed inside a range.  The number of
digits follows from the number of rows, so that a range has about
``ROWS_PER_RANGE`` rows at most, however many there are; the assignment is the
same for any number.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensa import rules


def split_hash(key: str = "clinician_id", seed: int = rules.SPLIT_SEED) -> F.Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


#: Rows of a range, on average at most; a range is one window group.
ROWS_PER_RANGE = 100_000


def range_digits(rows: int, rows_per_range: int = ROWS_PER_RANGE) -> int:
    """Hex digits that cut ``rows`` hashed rows into ranges of at most ``rows_per_range``, on average."""
    digits = 1
    while rows > rows_per_range * 16 ** digits:
        digits += 1
    return digits


def assign_split(df: DataFrame, label: str = "label", key: str = "clinician_id",
                 test: Decimal = rules.TEST_FRACTION, calibration: Decimal = Decimal("0.2"),
                 validation: Decimal = rules.VALIDATION_FRACTION, seed: int = rules.SPLIT_SEED,
                 prefix_len: int | None = None) -> DataFrame:
    """Adds ``split`` in {test, calibration, validation, train}.  ``prefix_len``, the hex
    digits of a range, is by default that of ``range_digits`` for the number of rows."""
    prefix_len = prefix_len or range_digits(df.count())
    h = df.withColumn("_h", split_hash(key, seed)).withColumn("_r", F.substring("_h", 1, prefix_len))
    counts = h.groupBy(label, "_r").agg(F.count(F.lit(1)).alias("_n"))
    # one row per (class, range): at most some 32 rows for every ROWS_PER_RANGE rows
    per_class = Window.partitionBy(label)
    before = Window.partitionBy(label).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        label, "_r",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
        F.sum("_n").over(per_class).alias("_nc"),
    )
    nc = F.col("_nc").cast("decimal(38,0)")
    t_test = F.ceil(nc * F.lit(test))
    t_cal = F.ceil((nc - t_test) * F.lit(calibration))
    t_val = F.ceil((nc - t_test - t_cal) * F.lit(validation))
    offsets = offsets.select(label, "_r", "_off", t_test.alias("_a"), (t_test + t_cal).alias("_b"),
                             (t_test + t_cal + t_val).alias("_c"))
    in_range = Window.partitionBy(label, "_r").orderBy("_h", key)
    ranked = (h.join(offsets, [label, "_r"], "left")
              .withColumn("_pos", F.col("_off") + F.row_number().over(in_range)))
    split = (F.when(F.col("_pos") <= F.col("_a"), "test")
             .when(F.col("_pos") <= F.col("_b"), "calibration")
             .when(F.col("_pos") <= F.col("_c"), "validation")
             .otherwise("train"))
    return ranked.withColumn("split", split).drop("_h", "_r", "_off", "_a", "_b", "_c", "_pos")
