"""Scalar helpers of the scoring operators."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: str | Column, digits: int = 2) -> Column:
    """Half-up rounding of a DOUBLE's binary value to ``digits`` places,
    computed as ``sign(x) * floor(|x| * 10^d + 0.5) / 10^d``.

    Spark's ``round`` rounds the shortest decimal text of the double (1.005
    -> 1.01) while IEEE-based SQL engines round the binary value (1.005 is
    stored as 1.00499... -> 1.00).  This form gives the same bits in both,
    so rankings built on it are reproducible across engines.
    """
    x = col(c)
    scale = 10 ** digits
    return F.signum(x) * F.floor(F.abs(x) * scale + F.lit(0.5)) / scale


def dec(value: str | int | float | Decimal) -> Column:
    """Decimal literal, so ``int * weight`` stays an exact decimal product."""
    return F.lit(Decimal(str(value)))
