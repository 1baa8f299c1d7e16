"""Lookup of values by a rule table of any size.

A rule table has a name and a value in each row.  Its size, which is counted,
decides how it is applied: a few rows become a map literal inside the projection (no
join), a table of bounded size is broadcast, a larger one is joined by a shuffle.  The
result is the same.  A name that is NULL, or in no row, gets the default; of a name
with several rows the largest value counts.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rule rows that become a literal, and that are broadcast.
LITERAL_ROWS = 200
BROADCAST_ROWS = 200_000


def with_lookup(df: DataFrame, column: str, output: str, table: DataFrame, default, name: str = "name", value: str = "value",
                literal_rows: int = LITERAL_ROWS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with ``output``: the value of the row of ``table`` that ``column`` names."""
    once = table.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("_name")).agg(F.max(value).alias("_value"))
    rows = once.limit(broadcast_rows + 1).count()
    if rows <= literal_rows:
        pairs = [(r["_name"], r["_value"]) for r in once.collect()]
        found = F.try_element_at(F.create_map(*map(F.lit, chain.from_iterable(pairs))), F.col(column)) if pairs else F.lit(None)
        return df.withColumn(output, F.coalesce(found, F.lit(default)))
    side = F.broadcast(once) if rows <= broadcast_rows else once.hint("merge")
    joined = df.join(side, F.col(column) == F.col("_name"), "left")
    return joined.select(*[c for c in df.columns if c != output], F.coalesce("_value", F.lit(default)).alias(output))
