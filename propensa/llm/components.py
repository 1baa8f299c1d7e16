"""Connected components of a link table, in DataFrame joins.

Each round every node takes the smallest label among its own and its neighbours'
labels, and then the label of that label (pointer jumping), so long chains
shrink fast.  The links are rewritten between labels after every round and
links within one component are dropped; the work ends when none is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node in ``links`` (a, b); the component is the
    smallest node of its kind.  Nodes without a link do not appear."""
    pairs = materialize(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links")
    label = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().select("node", F.col("node").alias("component"))
    label = materialize(label, "labels")
    while not pairs.isEmpty():
        # every label's smallest neighbour, then that one's: a < b in all pairs
        up = pairs.groupBy(F.col("b").alias("x")).agg(F.min("a").alias("y"))
        up = materialize(up, "up")
        two = up.alias("u").join(up.alias("v"), F.col("u.y") == F.col("v.x"), "left").select(F.col("u.x").alias("x"), F.coalesce("v.y", "u.y").alias("y"))
        two = materialize(two, "up-two")
        new = label.join(two, label["component"] == two["x"], "left").select("node", F.coalesce("y", "component").alias("component"))
        label = materialize(new, "labels")
        # a and b of a pair now go by their new labels
        ends = pairs.join(two.select(F.col("x").alias("a"), F.col("y").alias("a2")), "a", "left").join(two.select(F.col("x").alias("b"), F.col("y").alias("b2")), "b", "left")
        ends = ends.select(F.coalesce("a2", "a").alias("p"), F.coalesce("b2", "b").alias("q"))
        pairs = materialize(ends.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).where("a < b").distinct(), "links")
    return label
