"""Near-duplicate documents by an exact n-gram Jaccard join: a grouped prefix join.

A document's set is its distinct word shingles.  Two documents link when the
Jaccard similarity of their sets is at least ``percent`` / 100.  The result is
every document's class under these links (its connected component).

1. Order.  Shingles are ordered by how many documents have them, counted in
   ``2 ** BUCKET_BITS`` hash buckets over the whole table (ties and shared buckets
   by hash).  Any order gives the exact result; a frequency order keeps common
   passages out of the prefixes.  The bucket counts are what is broadcast; their
   number is fixed.
2. Prefix.  Two sets that link share one of the first n - ceil(percent/100 n) + 1
   shingles of both.  Documents with the same prefix and the same size are
   collapsed into one group, and only groups enter the prefix index.  Equal sets
   are in one group, and within it in one class with a single representative.
3. Group pairs.  Groups that share a prefix shingle are paired if their sizes and
   the shingle's positions leave enough room for the overlap.  A list of groups is
   not paired all with all: first every group is paired with the list's most
   central group (the one with the fewest rarer shingles), group pairs are
   expanded to members, members are verified, and components are formed.  This
   is done twice.  Then the lists that still span several components are
   paired completely, but only across components, and only where 256-bit
   parity signatures, which bound the symmetric difference from below, allow a
   link.  A pair left out lies inside one component, fails a bound that every link meets,
   or was verified before, so no two linked documents end in different classes.
4. Verify.  Members are compared by the shingle sets of their whole texts.

Skew: copies collapse before anything is shuffled by shingle; long lists cost
one row per member and round; the last pairing is a sort-merge join that adaptive
execution splits.  Texts travel only for the representatives of candidate pairs.

Words are the runs of characters other than ASCII white space, with A-Z in lower
case.  A text with fewer words than a shingle has is one shingle; one without
words, empty or null, has no shingle and links with nothing (its component is
its own doc_id).  Rows that repeat an id, and rows whose id is null, are
documents of their own; a class without any id has a null component_id; empty
tables give empty results; extra columns are ignored.  Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_name, materialize, text_parts, worker_cache
from .components import components

WORDS, PERCENT = 4, 85
BUCKET_BITS = 16
ROUNDS = 2
#: Distinct words whose hashes a Python worker keeps.
CACHE_WORDS = 400_000


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text."""
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.empty(0, dtype=np.uint64)
    known = worker_cache("jaccard")
    if len(known) > CACHE_WORDS:
        known.clear()
    for w in set(found).difference(known):
        known[w] = xxhash.xxh64_intdigest(w)
    h = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    n = min(words, len(h))
    out = np.full(len(h) - n + 1, n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = (out ^ h[i:len(h) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return np.unique(out)


def prefix_length(n, percent: int):
    return n - (percent * n + 99) // 100 + 1


def bucket(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def bucket_counts(docs: DataFrame, words: int) -> np.ndarray:
    """Number of (document, shingle) pairs by hash bucket, over all of ``docs`` (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
        for batch in batches:
            for _, texts in text_parts(batch, 0):
                for text in texts:
                    np.add.at(total, bucket(shingles(text, words)), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    # at most 2 ** BUCKET_BITS rows
    got = docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    for r in got:
        counts[r.bucket] = r.n
    return counts


def parity(s: np.ndarray) -> list[int]:
    """256-bit signature: bit i is the parity of the number of shingles that hash to i."""
    bits = np.bincount((s >> np.uint64(8)).astype(np.int64) & 255, minlength=256) & 1
    return np.packbits(bits.astype(np.uint8)).view("<i8").tolist()


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``key`` and ``tie``, never null, which tell texts of one id apart."""
    return docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("key"), F.xxhash64("text").alias("tie"))


def prefix_rows(docs: DataFrame, counts: np.ndarray, words: int, percent: int) -> DataFrame:
    """Per row of ``docs``: row, doc_id, key, tie, n, sig (of the set), grp (of prefix and size), prefix, bits."""
    sent = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for part, texts in (x for batch in batches for x in text_parts(batch, 3)):
            rows = []
            for text in texts:
                s = shingles(text, words)
                n = len(s)
                if not n:
                    rows.append((0, None, None, None, None))
                    continue
                prefix = s[np.lexsort((s, known[bucket(s)]))][:prefix_length(n, percent)].astype("<u8").tobytes()
                sig = xxhash.xxh3_128_hexdigest(s.tobytes())
                rows.append((n, sig, xxhash.xxh3_128_hexdigest(prefix + n.to_bytes(8, "little")), prefix, parity(s)))
            kinds = (pa.int64(), pa.string(), pa.string(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns[:3], *(pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds))],
                                             ["doc_id", "key", "tie", "n", "sig", "grp", "prefix", "bits"])

    schema = "doc_id long, key long, tie long, n long, sig string, grp string, prefix binary, bits array<long>"
    return keyed(docs).select("doc_id", "key", "tie", "text").mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())


def verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b: classes) that link."""
    ids = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    wanted = classes.join(ids, "cls").select("cls", "key", "tie")
    texts = materialize(keyed(docs).join(wanted, ["key", "tie"]).dropDuplicates(["cls"]).select("cls", "text"), "jaccard-texts")
    both = (pairs.join(texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, s = None, None  # rows of one a come together, so its set is made once
        for part, texts in (x for batch in batches for x in text_parts(batch, 3)):
            ok = []
            for text_a, text_b in zip(part.column(2).to_pylist(), texts):
                if text_a != last:
                    last, s = text_a, shingles(text_a, words)
                t = shingles(text_b, words)
                common = len(np.intersect1d(s, t, assume_unique=True))
                ok.append(100 * common >= percent * (len(s) + len(t) - common))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return materialize(both.mapInArrow(run, "a long, b long"), "jaccard-links")


def prefix_lists(heads: DataFrame) -> DataFrame:
    """(token, head, n, place) of ``heads`` (head, n, prefix): one row per prefix shingle."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                prefixes = [np.frombuffer(p, dtype="<i8") for p in part.column(2).to_pylist()]
                size = [len(p) for p in prefixes]
                place = np.concatenate([np.arange(n, dtype=np.int32) for n in size])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(prefixes)), pa.array(np.repeat(part.column(0).to_numpy(), size)),
                                                  pa.array(np.repeat(part.column(1).to_numpy(), size).astype(np.int32)), pa.array(place)], ["token", "head", "n", "place"])

    return heads.select("head", "n", "prefix").mapInArrow(spread, "token long, head long, n int, place int")


def need(percent: int):
    """Smallest intersection of linked x and y, from their sizes."""
    return F.ceil(percent * (F.col("x.n") + F.col("y.n")) / (100.0 + percent) - 1e-9)


def room(percent: int):
    """Whether the sizes of x and y, and the places of the shingle they share, leave room for a link's overlap."""
    n, m = F.col("x.n"), F.col("y.n")
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (F.least(n - F.col("x.place"), m - F.col("y.place")) >= need(percent))


def centre():
    """The most central group of a list: the one with the fewest rarer shingles."""
    return F.min(F.struct("place", "head", "n")).alias("h")


def star(lists: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Class pairs (a, b): each list's most central group (h) with every other
    group of it that has room for a link, with all the classes of that group."""
    pairs = (lists.select("head", "n", "place", "h").alias("x").where(F.col("head") != F.col("h.head"))
             .select("x.*", F.struct(F.col("h.n").alias("n"), F.col("h.place").alias("place")).alias("y")).where(room(percent))
             .select(F.col("h.head").alias("p"), F.col("head").alias("q")).distinct())
    more = members.select(F.col("head").alias("q"), "cls")
    return ordered(pairs.join(more, "q", "left").select(F.col("p").alias("a"), F.coalesce("cls", "q").alias("b")))


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def jaccard_classes(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id (the
    smallest doc_id of its class), stands (true for one row of each class) and
    key, tie (see :func:`keyed`)."""
    rows = materialize(prefix_rows(docs, bucket_counts(docs, words), words, percent), "jaccard-prefixes")
    # classes of equal sets; groups of equal prefix and size; heads are their first rows
    classes = materialize(
        rows.where("n > 0").groupBy("sig").agg(F.min(F.struct("row", "key", "tie")).alias("r"), F.first("grp").alias("grp"), F.first("n").alias("n"), F.first("bits").alias("bits"))
        .select("sig", F.col("r.row").alias("cls"), "r.key", "r.tie", "grp", F.col("n").cast("int").alias("n"), "bits"), "jaccard-classes")
    groups = classes.groupBy("grp").agg(F.min("cls").alias("head"), F.count("*").alias("members"))
    members = materialize(classes.join(groups.where("members > 1"), "grp").select("head", "cls"), "jaccard-members")  # of groups of several classes
    heads = materialize(rows.select("row", "n", "prefix").join(groups.select(F.col("head").alias("row")), "row").withColumnRenamed("row", "head"), "jaccard-heads")

    entries = prefix_lists(heads)
    several = entries.groupBy("token").agg(centre(), F.count("*").alias("many")).where("many > 1").select("token", "h")
    lists = materialize(entries.join(several, "token"), "jaccard-lists")

    open_lists, tried, links, label = lists, None, None, None
    for turn in range(ROUNDS):
        pairs = star(open_lists, members, percent)
        if turn == 0:  # classes of one group, against its head
            pairs = pairs.unionAll(members.where("head < cls").select(F.col("head").alias("a"), F.col("cls").alias("b"))).distinct()
        else:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "jaccard-pairs")
        got = verify(pairs, classes, docs, words, percent)
        tried = pairs if tried is None else tried.unionAll(pairs)
        links = got if links is None else links.unionAll(got)
        label = components(links)
        state = materialize(state_of(classes, groups, label), "jaccard-state")
        mixed = mixed_lists(lists, state)
        if turn + 1 < ROUNDS:
            left = open_lists.where(F.col("head") != F.col("h.head")).drop("h").join(mixed, "token", "left_semi")
            left = materialize(left, "jaccard-open")
            open_lists = left.join(left.groupBy("token").agg(centre(), F.count("*").alias("many")).where("many > 1").select("token", "h"), "token")

    # what remains: classes in different components, within lists and within groups
    mine = state.join(classes.select("cls", "bits", F.col("n").alias("size")), "cls")
    rest = lists.join(mixed, "token", "left_semi").select("token", "head", "place").join(mine, "head").select("token", "cls", F.col("size").alias("n"), "place", "bits", "component")
    inside = mine.join(members.select("cls"), "cls", "left_semi").select(F.xxhash64("head").alias("token"), "cls", F.col("size").alias("n"), F.lit(0).alias("place"), "bits", "component")
    inside = inside.join(inside.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("token"), "token", "left_semi")
    rest = materialize(rest.unionAll(inside), "jaccard-rest")
    apart = sum((F.bit_count(F.col("x.bits")[i].bitwiseXOR(F.col("y.bits")[i])) for i in range(4)), F.lit(0))
    across = (rest.alias("x").join(rest.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.cls") < F.col("y.cls")) & (F.col("x.component") != F.col("y.component"))
                                   & room(percent) & (apart <= F.col("x.n") + F.col("y.n") - 2 * need(percent)))
              .select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).distinct().join(tried, ["a", "b"], "left_anti"))
    across = materialize(across, "jaccard-pairs")
    if not across.isEmpty():
        label = components(links.unionAll(verify(across, classes, docs, words, percent)))

    of_sig = classes.select("sig", "cls").join(label.select(F.col("node").alias("cls"), "component"), "cls", "left").select("sig", F.coalesce("component", "cls").alias("component"))
    # the row that stands for a class: smallest id (null ids last), then first row
    stand = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    by_sig = rows.where("n > 0").groupBy("sig").agg(stand.alias("s")).join(of_sig, "sig")
    by_class = by_sig.groupBy("component").agg(F.min("s").alias("s"))
    of_class = by_sig.select("sig", "component").join(by_class, "component").select("sig", F.col("s.doc_id").alias("component_id"), F.col("s.row").alias("stand"))
    return (rows.select("doc_id", "n", "sig", "row", "key", "tie").join(of_class, "sig", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    F.when(F.col("n") > 0, F.col("stand") == F.col("row")).otherwise(True).alias("stands"), "key", "tie"))


def one_of_each(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``docs`` (doc_id, text, ...) with one row of each class; rows without words stay."""
    classes = jaccard_classes(docs, words, percent)
    key, tie = fresh_name("_key", docs.columns), fresh_name("_tie", docs.columns)
    marked = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), tie: F.xxhash64("text")})
    wordless = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    stay = classes.where("stands and n_shingles > 0").select(F.col("key").alias(key), F.col("tie").alias(tie)).distinct()
    kept = marked.where(~wordless).join(stay, [key, tie], "left_semi").dropDuplicates([key, tie])
    return kept.unionByName(marked.where(wordless)).select(*docs.columns)


def state_of(classes: DataFrame, groups: DataFrame, label: DataFrame) -> DataFrame:
    """(head, cls, component) of every class."""
    of = classes.select("cls", "grp").join(label.select(F.col("node").alias("cls"), "component"), "cls", "left")
    return of.join(groups.select("grp", "head"), "grp").select("head", "cls", F.coalesce("component", "cls").alias("component"))


def mixed_lists(lists: DataFrame, state: DataFrame) -> DataFrame:
    """(token) of the lists whose groups, with all their classes, are in more than one component."""
    by_head = state.groupBy("head").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return (lists.select("token", "head").join(by_head, "head").groupBy("token").agg(F.min("low").alias("low"), F.max("high").alias("high"))
            .where("low <> high").select("token"))
