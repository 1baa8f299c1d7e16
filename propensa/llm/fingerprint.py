"""Document fingerprints as invertible Bloom lookup sketches, in DataFrame functions only.

A text's paragraphs are its lines, cut after every word whose hash is 0 modulo
``DIVISOR`` and after ``LONGEST`` words without one; the rule is the same for texts of
all lengths.  A word that is put in or taken out changes the paragraph it is in, and
no paragraph beyond the next cut.

The 64-bit digests of the distinct paragraphs go into a sketch of three parts with
2^b cells each; each digest is in one cell of each part, and a cell holds a count,
the XOR of its digests and the XOR of their check values.  The fingerprint is the
sketch with b = ``SIDE_BITS``, written as hexadecimal text.

Two versions are compared by subtracting their sketches cell by cell and
peeling: a cell whose count is 1 or -1 and whose check value fits holds one
digest, which is recorded and taken out of its three cells, and so on.  How many
cells a pair's sketches have follows from an estimate of the difference, made from
the counts of the two fingerprints.  When cells remain, the sketch was too small for
the difference, and sketches with twice the cells are tried.  The digests of a pair
with more than ``PER_BLOCK`` of them are dealt into blocks by their highest bits, with
sketches for each block, which bounds a sketch also for very long texts.  Cells are
filled by halving the digests bit after bit, so the work grows with n log n of a
text's paragraphs, within its own row: nothing is shuffled but the texts, once, by
:func:`with_next`.  The number of recovered digests d gives the likeness
(a + b - d) / (a + b + d) of texts with a and b distinct paragraphs, which is the
share of paragraphs they have in common among all they have; 1 if both have none.

Edge cases: a null text is empty, and so is its fingerprint's sketch; equal
texts have equal fingerprints; repeated lines of a text count once; documents
with a null id come last in descending order, ties of an id are ordered by
text hash; a table of one row is its own next document; an empty table gives an
empty result; extra columns are ignored by :func:`fingerprints`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Cells of a part of a fingerprint, as a power of two.
SIDE_BITS = 3
#: A line is cut after one distinct word of so many, and after so many words at the latest.
DIVISOR = 8
LONGEST = 32
#: Digests of a pair in a block (one sketch each), estimated differences for a cell of a part, rounds of peeling.
PER_BLOCK = 256
LOAD = 1.5
ROUNDS = 24
#: Sketches tried for a block, each with twice the cells, and the cells of a part at most.
TRIES = 10
MOST_BITS = 20
MAX_BUCKETS = 1000


def cut_digests(text: Column) -> Column:
    """Distinct 64-bit digests of a text's paragraphs, cut by the words and not by the text's length."""
    tokens = F.split(F.replace(text, F.lit("\n"), F.lit(" \n ")), " ", -1)
    cut = F.transform(tokens, lambda w: F.when(F.pmod(F.xxhash64(w), F.lit(DIVISOR)) == 0, F.concat(w, F.lit("\n"))).otherwise(w))
    found = F.regexp_extract_all(F.array_join(cut, " "), F.lit(rf"((?:[^ \n]+ ?){{1,{LONGEST}}})"), 1)
    return F.array_distinct(F.transform(found, lambda u: F.xxhash64(F.rtrim(u))))


def check_value(key: Column) -> Column:
    return F.xxhash64(key, F.lit(17)).bitwiseAND(F.lit(0xFFFFFFFF))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once (bodies of lambdas have no common
    subexpressions).  A fold over nothing: unlike a transformation, it does not copy the result."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda kept, _: kept, use)


def deal(items: Column, bits: Column, low: int | Column, key: Callable[[Column], Column] = lambda u: u) -> Column:
    """``items`` as 2^bits arrays, by bits ``low`` to ``low + bits - 1`` of the ``key`` of each: parted
    by two bits after two bits (and one, if they are odd), the highest first, so that array i has the value i."""
    def part(groups: Column, shift: Column, ways: int) -> Column:
        def at(v: int) -> Callable[[Column], Column]:
            return lambda u: F.call_function("shiftrightunsigned", key(u), shift).bitwiseAND(F.lit(ways - 1).cast("long")) == v

        return F.flatten(F.transform(groups, lambda g: F.when(F.size(g) == 0, F.array_repeat(g, ways)).otherwise(F.array(*(F.filter(g, at(v)) for v in range(ways))))))

    first = F.when(bits % 2 == 1, part(F.array(items), bits - 1 + low, 2)).otherwise(F.array(items))
    shifts = F.when(bits > 1, F.sequence(bits - bits % 2 - 2 + low, F.lit(low), F.lit(-2))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(shifts, first, lambda groups, shift: part(groups, shift, 4))


def parts(items: Column, bits: Column, key: Callable[[Column], Column] = lambda u: u) -> Column:
    """``items`` by cell: those of part 0, 1 and 2, with 2^bits cells a part, by bits of their own for each part."""
    return F.concat(*(deal(items, bits, 20 * p, key) for p in range(3)))


def sketch(keys: Column, bits: Column) -> Column:
    """Cells of a set of digests, part after part, with 2^bits cells a part: a struct
    of their counts c, XORs k and XORs of check values x (arrays of long values)."""
    zero = F.lit(0).cast("long")
    return let(parts(keys, bits), lambda cells: F.struct(
        F.transform(cells, lambda own: F.size(own).cast("long")).alias("c"),
        F.transform(cells, lambda own: F.aggregate(own, zero, lambda a, u: a.bitwiseXOR(u))).alias("k"),
        F.transform(cells, lambda own: F.aggregate(own, zero, lambda a, u: a.bitwiseXOR(check_value(u)))).alias("x")))


def subtract(a: Column, b: Column) -> Column:
    return let(F.struct(a.alias("a"), b.alias("b")), lambda s: F.struct(
        F.zip_with(s["a"]["c"], s["b"]["c"], lambda p, q: p - q).alias("c"), F.zip_with(s["a"]["k"], s["b"]["k"], lambda p, q: p.bitwiseXOR(q)).alias("k"),
        F.zip_with(s["a"]["x"], s["b"]["x"], lambda p, q: p.bitwiseXOR(q)).alias("x")))


def peel(cells: Column, bits: Column, rounds: int = ROUNDS) -> Column:
    """Struct (cells, found, mine, theirs) after peeling a subtracted sketch: the cells that
    are left and the number of recovered digests (the other two: those that ``rounds`` left over)."""
    zero = F.lit(0).cast("long")

    def alone(left: Column, side: int) -> Column:
        """Digests of the cells that hold one of the first (1) or second (-1) set, each once."""
        return F.array_distinct(F.filter(left["k"], lambda k, i: (left["c"][i] == side) & (left["x"][i] == check_value(k))))

    def state(cells: Column, found: Column) -> Column:
        return let(cells, lambda left: F.struct(left.alias("cells"), found.alias("found"), alone(left, 1).alias("mine"), alone(left, -1).alias("theirs")))

    def signed(keys: Column, sign: int) -> Column:
        return F.transform(keys, lambda u: F.struct(u.alias("u"), F.lit(sign).cast("long").alias("sign")))

    def without(s: Column, taken: Column) -> Column:
        return F.struct(
            F.zip_with(s["cells"]["c"], taken, lambda c, out: F.aggregate(out, c, lambda a, t: a - t["sign"])).alias("c"),
            F.zip_with(s["cells"]["k"], taken, lambda k, out: F.aggregate(out, k, lambda a, t: a.bitwiseXOR(t["u"]))).alias("k"),
            F.zip_with(s["cells"]["x"], taken, lambda x, out: F.aggregate(out, x, lambda a, t: a.bitwiseXOR(check_value(t["u"])))).alias("x"))

    def step(s: Column, _: Column) -> Column:
        # the digests of all cells that hold one leave their three cells at once
        n = F.size(s["mine"]) + F.size(s["theirs"])
        left = let(parts(F.concat(signed(s["mine"], 1), signed(s["theirs"], -1)), bits, lambda t: t["u"]), lambda taken: without(s, taken))
        return F.when(n == 0, s).otherwise(state(left, s["found"] + n))

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), state(cells, zero), step)


def rest(cells: Column) -> Column:
    """Whether cells remain, so that the difference was not recovered."""
    return F.exists(cells["c"], lambda v: v != 0) | F.exists(cells["k"], lambda v: v != 0) | F.exists(cells["x"], lambda v: v != 0)


def text_of(cells: Column) -> Column:
    """A sketch as hexadecimal text: count, digests, check of each cell."""
    return F.array_join(F.transform(cells["c"], lambda c, i: F.concat(F.hex(c), F.lit("."), F.lpad(F.hex(cells["k"][i]), 16, "0"), F.lpad(F.hex(cells["x"][i]), 8, "0"))), "")


def likeness(a: Column, b: Column, d: Column) -> Column:
    return F.when(a + b == 0, F.lit(1.0)).otherwise((a + b - d).cast("double") / (a + b + d).cast("double"))


def power(n: Column) -> Column:
    """The least whole b with 2^b >= n."""
    return F.ceil(F.log2(F.greatest(n.cast("double"), F.lit(1.0)))).cast("int")


def estimate(a: Column, b: Column) -> Column:
    """Estimated number of digests that only one of two fingerprints has, from their
    counts: with m cells a part, the squares of a part's differences sum up to
    (1 - 1/m) d + D^2 / m on average, D being the difference of the sizes."""
    m = 1 << SIDE_BITS
    gaps = F.zip_with(a["c"], b["c"], lambda p, q: p - q)
    squares = F.aggregate(gaps, F.lit(0).cast("long"), lambda s, v: s + v * v)
    total = F.aggregate(gaps, F.lit(0).cast("long"), lambda s, v: s + v)
    return (squares / 3 - total * total / (9 * m)) * m / (m - 1)


def recover(a: Column, b: Column, sketch_a: Column, sketch_b: Column, rounds: int = ROUNDS) -> Column:
    """Struct (d, tries): the number of digests that one of the sets ``a`` and ``b``
    has and the other has not, recovered from subtracted sketches, and the largest
    number of sketches that a block took; null where even the last try failed."""
    blocks = power((F.size(a) + F.size(b)) / PER_BLOCK)
    first = F.greatest(F.lit(SIDE_BITS), power(estimate(sketch_a, sketch_b) / LOAD / F.call_function("shiftleft", F.lit(1), blocks)))

    def attempt(u: Column, v: Column, bits: Column, tries: Column) -> Column:
        return let(peel(subtract(sketch(u, bits), sketch(v, bits)), bits, rounds), lambda s: F.struct(
            F.when(~rest(s["cells"]), s["found"]).alias("d"), tries.cast("int").alias("tries")))

    def one(sets: Column, bits: Column) -> Column:
        start = F.struct(F.lit(None).cast("long").alias("d"), F.lit(0).alias("tries"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(TRIES - 1)), start, lambda s, t: F.when(s["d"].isNotNull(), s).otherwise(
            let(F.least(bits + t, F.lit(MOST_BITS)), lambda more: attempt(sets["a"], sets["b"], more, t + 1))))

    def all_blocks(size: Column) -> Column:
        dealt = lambda keys: deal(keys, size["blocks"], 64 - size["blocks"])
        sets = F.zip_with(dealt(a), dealt(b), lambda u, v: F.struct(u.alias("a"), v.alias("b")))
        got = F.transform(sets, lambda s: one(s, size["bits"]))
        return F.aggregate(got, F.struct(F.lit(0).cast("long").alias("d"), F.lit(0).alias("tries")), lambda s, r: F.struct(
            (s["d"] + r["d"]).alias("d"), F.greatest(s["tries"], r["tries"]).alias("tries")))

    return let(F.struct(blocks.alias("blocks"), first.alias("bits")), all_blocks)


def recovered(d: Column) -> Column:
    """``d``, or an error where a difference was not recovered by any sketch."""
    return F.coalesce(d, F.raise_error(F.lit("a difference was not recovered from the largest sketch")).cast("long"))


def differences(pairs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pair, d, tries) of ``pairs`` (pair, a, b: arrays of distinct digests): how many
    digests one side has and the other has not, recovered from subtracted sketches."""
    small = pairs.select("pair", "a", "b", sketch(F.col("a"), F.lit(SIDE_BITS)).alias("s"), sketch(F.col("b"), F.lit(SIDE_BITS)).alias("t"))
    got = small.select("pair", recover(F.col("a"), F.col("b"), F.col("s"), F.col("t"), rounds).alias("r"))
    return got.select("pair", recovered(F.col("r.d")).alias("d"), F.col("r.tries").alias("tries"))


def with_next(docs: DataFrame, buckets: int) -> DataFrame:
    """``docs`` (doc_id, text) with ``next_text``: the text of the document that
    follows in descending order of doc_id; the first follows the last.

    Rows are dealt into ranges of doc_id by quantiles and sorted within each;
    only the first row of each range (at most ``MAX_BUCKETS``) crosses ranges."""
    spark = docs.sparkSession
    buckets = max(1, min(MAX_BUCKETS, buckets))
    cuts = docs.select(F.col("doc_id").cast("double").alias("d")).approxQuantile("d", [i / buckets for i in range(1, buckets)], 0.2 / buckets) if buckets > 1 else []
    splits = [float("-inf"), *sorted(set(cuts or [])), float("inf")]
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("doc_id").cast("double").alias("_d"))
    if len(splits) > 2:
        keyed = Bucketizer(splits=splits, inputCol="_d", outputCol="_b", handleInvalid="keep").transform(keyed)
    else:
        keyed = keyed.withColumn("_b", F.lit(0.0))
    keyed = keyed.select("doc_id", "text", F.when(F.col("_d").isNull(), F.lit(len(splits))).otherwise(F.lit(len(splits) - 1) - F.col("_b")).cast("int").alias("place"),
                         F.xxhash64("text").alias("tie"))
    firsts = keyed.groupBy("place").agg(F.max(F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("d"), "tie")).alias("top"))
    tops = sorted((r.place, r.top.d, r.top.tie) for r in firsts.collect())
    if not tops:
        return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.lit("").alias("next_text"))
    before = [(tops[i - 1][0], *t) for i, t in enumerate(tops)]
    link = spark.createDataFrame(before, "before int, place int, d long, tie long")
    opens = (keyed.join(F.broadcast(link), (keyed["place"] == link["place"]) & (keyed["tie"] == link["tie"])
                        & (F.coalesce(keyed["doc_id"].cast("long"), F.lit(-(1 << 63))) == link["d"]))
             .groupBy(link["before"].alias("place")).agg(F.first("text").alias("opening")))
    order = Window.partitionBy("place").orderBy(F.col("doc_id").desc_nulls_last(), F.col("tie").desc())
    led = keyed.withColumn("following", F.lead("text").over(order))
    return led.join(opens, "place", "left").select("doc_id", "text", F.coalesce("following", "opening", F.lit("")).alias("next_text"))


def edited_text(text: Column, next_text: Column) -> Column:
    """``text`` with its last floor(n/3) code points replaced by the first as many of ``next_text``."""
    k = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - k), F.substring(next_text, F.lit(1), k))


def fingerprints(docs: DataFrame, digests: Callable[[Column], Column] = cut_digests) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next, the numbers of
    paragraphs that differ (differing_edited, differing_next) and of sketches it
    took (tries_edited, tries_next).  ``digests`` makes the distinct digests of a
    text's paragraphs."""
    spark = docs.sparkSession
    rows = docs.count()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    edited = with_next(docs, min(2 * parts, 1 + rows // 200)).withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    base = materialize(edited.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        digests(F.col("text")).alias("own"), digests(F.col("edited")).alias("changed"), digests(F.col("next_text")).alias("following")), "fingerprint-digests")
    side = F.lit(SIDE_BITS)
    small = base.select("*", sketch(F.col("own"), side).alias("s"), sketch(F.col("changed"), side).alias("t"), sketch(F.col("following"), side).alias("u"))
    got = small.select("*", recover(F.col("own"), F.col("changed"), F.col("s"), F.col("t")).alias("e"), recover(F.col("own"), F.col("following"), F.col("s"), F.col("u")).alias("f"))
    got = got.select("*", recovered(F.col("e.d")).alias("de"), recovered(F.col("f.d")).alias("dn"))
    n = lambda c: F.size(c).cast("long")
    return got.select(
        "doc_id", "n_chars", "edited_sha256", text_of(F.col("s")).alias("fingerprint"), text_of(F.col("t")).alias("edited_fingerprint"),
        likeness(n("own"), n("changed"), F.col("de")).alias("near_edited"), likeness(n("own"), n("following"), F.col("dn")).alias("near_next"),
        F.col("de").alias("differing_edited"), F.col("dn").alias("differing_next"), F.col("e.tries").alias("tries_edited"), F.col("f.tries").alias("tries_next"))
