"""A Merkle manifest of a data set, in DataFrame functions only.

Every row is a leaf: the SHA-256 of its columns, each written as ``-`` (null) or
as its UTF-8 byte count, ``:`` and its value.  The leaves of a group (a source)
ascend by the key; while a group has several nodes, every ``FANOUT`` consecutive
ones (the last run may be shorter, even one) become one parent, the hash of their
digests.  What remains is the group's subroot.  The subroots, ordered by group
(null first, then bytewise), make a tree of the same kind with one root.

A level is a slot pivot: its nodes are grouped by parent, and ``FANOUT``
conditional aggregates spread them into one column a slot.  The columns in a row
hash to the parent; without the own slot's column they are a node's siblings,
kept as the text ``left`` and the text ``right`` of it.  The paths go down again:
a parent's path is joined to it once, and its children take it over with their own
siblings in front, so a leaf's path needs no shuffle of its own.

Places within a group come from one sort over all rows: ranges of (group, key,
leaf) with a row number in each, and offsets of a group's ranges, of which there
are at most as many as partitions.  So a group of any size is dealt over many
tasks, and no task holds more than one range; a parent has at most ``FANOUT``
children.

Edge cases: null values are ``-``; a null key comes first in its group; rows of
one key are ordered by their leaf, rows that repeat are leaves each; a group of
one row has its leaf as subroot; a single subroot is the root; an empty table has
no rows and no root.  Columns not named are ignored, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

FANOUT = 16
#: Bits of a row number within its partition in ``monotonically_increasing_id``.
ROW_BITS = 33


def digest(*parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of texts one after another; nulls are left out."""
    return F.sha2(F.concat_ws("", *parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return digest(*map(field, values))


def placed(nodes: DataFrame, name: str) -> DataFrame:
    """``nodes`` (grp, rank, digest and others) with ``pos``, the place within grp in
    order of (rank, digest) from 0, and ``n``, the size of grp."""
    keyed = nodes.withColumn("tie", F.monotonically_increasing_id())  # rows that repeat are dealt over ranges, too
    order = ["grp", "rank", "digest", "tie"]
    rows = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("rank", "tie")
    rows = materialize(rows.withColumn("at", F.monotonically_increasing_id()), f"{name}-sorted")
    part = F.shiftright("at", ROW_BITS)
    ranges = rows.groupBy("grp", part.alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy("grp")
    before = F.coalesce(F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # written, so that its size is known when the join is planned
    ranges = materialize(ranges.select("grp", "part", "first", before.alias("before"), F.sum("rows").over(whole).alias("n")), f"{name}-ranges")
    return rows.withColumn("part", part).join(ranges, ["grp", "part"]).select(
        *[c for c in rows.columns if c != "at"], (F.col("at") - F.col("first") + F.col("before")).alias("pos"), "n")


def slots(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """One row (grp, pos, n, digest, c0, c1, ...) for each parent of ``nodes``, with
    the struct of its child's ``carried`` columns in each slot's column."""
    own = F.pmod("pos", F.lit(FANOUT))
    spread = [F.max(F.when(own == s, F.struct(*carried))).alias(f"c{s}") for s in range(FANOUT)]
    wide = nodes.groupBy("grp", F.floor(F.col("pos") / FANOUT).cast("long").alias("pos"), F.ceil(F.col("n") / FANOUT).cast("long").alias("n")).agg(*spread)
    return wide.withColumn("digest", digest(*[F.col(f"c{s}.digest") for s in range(FANOUT)]))


def children(wide: DataFrame, carried: list[str], passed: list[str]) -> DataFrame:
    """The children of ``slots``' rows, which have ``path`` and the ``passed`` columns
    besides: their carried columns, place and path, siblings of the own level in front."""
    d = [F.col(f"c{s}.digest") for s in range(FANOUT)]

    def slot(s: int) -> Column:
        step = F.struct(F.concat_ws("", *d[:s]).alias("left"), F.concat_ws("", *d[s + 1:]).alias("right"))
        return F.when(F.col(f"c{s}").isNotNull(), F.struct((F.col("pos") * FANOUT + s).alias("pos"), F.col(f"c{s}").alias("c"), step.alias("step")))

    each = wide.select("grp", "path", *passed, F.explode(F.array(*map(slot, range(FANOUT)))).alias("e")).where(F.col("e").isNotNull())
    return each.select("grp", F.col("e.pos").alias("pos"), *[F.col(f"e.c.{c}").alias(c) for c in carried], *passed,
                       F.concat(F.array("e.step"), "path").alias("path"))


def tree(nodes: DataFrame, carried: list[str], name: str) -> tuple[list[DataFrame], DataFrame]:
    """(levels of ``slots``, lowest first; (grp, digest) of the roots) over ``nodes``
    (grp, pos, n, digest and others), which hold every group's nodes.  A group is in
    the levels in which it has several nodes."""
    levels, roots, cols = [], nodes.where("n = 1").select("grp", "digest"), carried
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        up = materialize(slots(nodes.where("n > 1"), cols), f"{name}-{len(levels) + 1}")
        levels.append(up)
        roots = roots.unionAll(up.where("n = 1").select("grp", "digest"))
        nodes, cols, most = up.select("grp", "pos", "n", "digest"), ["digest"], -(-most // FANOUT)
    return levels, roots


def paths(levels: list[DataFrame], top: DataFrame, carried: list[str], alone: DataFrame) -> DataFrame:
    """(carried, other columns of ``top``, path) of every leaf: ``top`` has grp, path and
    others for every group's root, ``alone`` (grp, carried) of groups without levels."""
    passed = [c for c in top.columns if c not in ("grp", "path")]
    out = alone.join(top, "grp").select(*carried, *passed, "path")
    down = None
    for i in reversed(range(len(levels))):
        wide = levels[i]
        cols = [*wide.columns, *passed, "path"]
        known = wide.where("n = 1").join(top, "grp").select(*cols)
        if down is not None:
            known = known.unionAll(wide.where("n > 1").join(down.select("grp", "pos", *passed, "path"), ["grp", "pos"]).select(*cols))
        down = children(known, carried if i == 0 else ["digest"], passed)
    return out if down is None else out.unionAll(down.select(*carried, *passed, "path"))


def manifest(docs: DataFrame, columns: list[str], key: str = "doc_id", group: str = "source", changed: dict[str, Column] | None = None) -> DataFrame:
    """Per row of ``docs``: its ``key``, leaf, subroot, root, and path: an array from
    the leaf up of structs (left, right), the digests of the siblings on either side.
    ``changed_leaf`` is the leaf with the columns in ``changed`` in place of the row's."""
    changed = changed or {}
    grp = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))
    rows = docs.select(grp.alias("grp"), F.col(key).alias("rank"), F.col(key).alias("key"), leaf_digest(*[F.col(c) for c in columns]).alias("digest"),
                       leaf_digest(*[changed.get(c, F.col(c)) for c in columns]).alias("changed"))
    leaves = placed(rows, "merkle-leaves")
    carried = ["digest", "changed", "key"]
    levels, subroots = tree(leaves, carried, "merkle")
    tops = placed(subroots.select(F.lit(0).alias("grp"), F.col("grp").alias("rank"), "digest", F.col("grp").alias("src")), "merkle-tops")
    top_levels, root = tree(tops, ["digest", "src"], "merkle-top")
    found = root.first()
    none = F.array().cast("array<struct<left:string,right:string>>")
    over = paths(top_levels, root.select("grp", none.alias("path")), ["digest", "src"], tops.where("n = 1"))
    # every level below is joined to it
    over = materialize(over.select(F.col("src").alias("grp"), F.col("digest").alias("subroot"), "path"), "merkle-over")
    return paths(levels, over, carried, leaves.where("n = 1")).select(
        F.col("key").alias(key), F.col("digest").alias("leaf"), F.col("changed").alias("changed_leaf"), "subroot",
        F.lit(found.digest if found else None).cast("string").alias("root"), "path")


def proof_digest(path: Column) -> Column:
    """Hash of all siblings of a path, level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, leaf, lambda d, s: digest(s["left"], d, s["right"]))
