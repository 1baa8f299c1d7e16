"""Line deduplication over content-defined chunks of lines, in DataFrame functions only.

A text is split into lines; each line gets a hash, and a rolling hash over a
window of ``window`` line hashes decides where a chunk ends: after line i when
the rolling value modulo ``divisor`` is 0.  Boundaries depend on the lines near
them only, so inserting or deleting lines elsewhere does not move them.  A line
of at least ``min_words`` words (a passage) is a chunk by itself: the chunk
before it ends, and it ends its own.

A chunk of at least ``min_lines`` lines, or such a long line, that occurs more
than once in the whole table is kept at its first occurrence (smallest doc_id,
then position) and removed everywhere else.  "Occurs" means the same bytes:
chunks are brought together by hash, and only those whose bytes equal those of
the first occurrence with that hash are removed.

Plan: one scan makes chunk rows with a digest and no text; one aggregation by
digest (combined on the map side, so a chunk that a third of all documents
share costs one row per task) finds the first occurrence of every repeated
digest.  Only chunks with a repeated digest are joined with it; their bytes
are compared against the first occurrence's bytes.  The texts are put together
again from the surviving line ranges of the documents that lose something;
all others pass through.

Edge cases: null texts stay null and empty texts empty; a text without a
newline is one line; doc_id null sorts before every id (its chunks count as
first); rows that repeat a doc_id are told apart by their text and are treated
like copies; an empty table gives an empty result; extra columns pass through.

:func:`line_dedup` finds a repeated passage only as far as its chunks lie
wholly inside it, so of passages of a few lines of under ``min_words`` words it
leaves most.  :func:`passage_dedup` has no chunks: every run of ``min_lines``
adjacent lines is looked up, so a repeated passage of that many whole lines or
more goes whatever surrounds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh_name, materialize

WINDOW = 2
DIVISOR = 4
MIN_LINES = 2
MIN_WORDS = 50
#: Rolling hash: value = sum of line hash * BASE^(distance to the window's end), modulo MODULUS.
BASE = 1_000_003
MODULUS = 2_147_483_647


def line_hash(line: Column) -> Column:
    """A line's 32-bit hash as a long: the first 8 hex digits of its MD5."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long")


def words(line: Column) -> Column:
    """Number of space-separated words of a line, as spaces plus one."""
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _ends(window: int, divisor: int, min_words: int) -> Column:
    """Positions (0-based) of ``_lines`` after which a chunk ends, in order; the last line always ends one."""
    def at(i: Column, back: int) -> Column:
        return F.when(i >= back, F.element_at("_hashes", (i - back + 1).cast("int"))).otherwise(F.lit(0).cast("long"))

    def rolling(i: Column) -> Column:
        total, power = F.lit(0).cast("long"), 1
        for back in range(window):
            total, power = (total + at(i, back) % MODULUS * power) % MODULUS, power * BASE % MODULUS
        return total

    last = F.size("_lines") - 1
    is_end = lambda i: (
        (rolling(i) % divisor == 0) | F.element_at("_long", i + 1) | ((i < last) & F.element_at("_long", F.least(i + 2, last + 1))) | (i == last))
    return F.filter(F.sequence(F.lit(0), last), is_end)


def chunk_rows(docs: DataFrame, window: int, divisor: int, min_words: int) -> DataFrame:
    """``docs`` (doc_id, text) with one row per chunk: doc_id, doc_key, start, n_lines, long_line, chunk (its text)."""
    lined = (docs.where(F.col("text").isNotNull() & (F.col("text") != ""))
             .select("doc_id", F.md5(F.col("text").cast("binary")).alias("doc_key"), F.split("text", "\n", -1).alias("_lines")))
    hashed = lined.select("*", F.transform("_lines", line_hash).alias("_hashes"),
                          F.transform("_lines", lambda x: words(x) >= min_words).alias("_long"))
    ended = hashed.select("doc_id", "doc_key", "_lines", "_long", _ends(window, divisor, min_words).alias("_ends"))
    spans = F.transform("_ends", lambda e, k: F.struct(
        F.when(k == 0, 0).otherwise(F.element_at("_ends", F.greatest(k, F.lit(1))) + 1).cast("int").alias("start"), e.alias("end")))
    rows = ended.select("doc_id", "doc_key", "_lines", "_long", F.explode(spans).alias("s"))
    size = (F.col("s.end") - F.col("s.start") + 1).cast("int")
    return rows.select("doc_id", "doc_key", F.col("s.start").alias("start"), size.alias("n_lines"),
                       F.element_at("_long", F.col("s.start") + 1).alias("long_line"),
                       F.array_join(F.slice("_lines", F.col("s.start") + 1, size), "\n").alias("chunk"))


def line_dedup(docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR, min_lines: int = MIN_LINES,
               min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (doc_id, text, ...) with text without its repeated chunks, and
    the columns n_lines, n_lines_removed, n_chunks_removed (long; 0 for null text).
    A column of the input that has one of these names is replaced."""
    out_cols = [c for c in docs.columns if c.lower() not in ("n_lines", "n_lines_removed", "n_chunks_removed")]
    key, mark, mark_id, mark_key = (fresh_name(n, docs.columns) for n in ("_doc_key", "_gone", "_gone_id", "_gone_key"))

    every = chunk_rows(docs, window, divisor, min_words)
    able = every.where((F.col("n_lines") >= min_lines) | F.col("long_line"))
    digest = able.select("doc_id", "doc_key", "start", "n_lines", F.xxhash64("chunk").alias("h1"), F.xxhash64(F.lit(1), "chunk").alias("h2"), "chunk")
    place = F.struct("doc_id", "doc_key", "start")
    repeated = (digest.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
                .select("h1", "h2", "first"))
    repeated = materialize(repeated, "line-dedup-repeated")

    # only chunks with a repeated digest travel with their bytes, to be compared
    hold = materialize(digest.join(repeated, ["h1", "h2"]), "line-dedup-chunks")
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("doc_key") == F.col("first.doc_key")) & (F.col("start") == F.col("first.start"))
    original = hold.where(is_first).groupBy("h1", "h2").agg(F.first("chunk").alias("first_chunk"))
    gone = (hold.where(~is_first).join(original, ["h1", "h2"]).where(F.col("chunk") == F.col("first_chunk"))
            .groupBy("doc_id", "doc_key").agg(F.sort_array(F.collect_set(F.struct("start", "n_lines"))).alias("gone")))

    marked = docs.withColumn(key, F.md5(F.col("text").cast("binary")))
    gone = gone.select(F.col("doc_id").alias(mark_id), F.col("doc_key").alias(mark_key), F.col("gone").alias(mark))
    both = marked.join(gone, F.col(mark_id).eqNullSafe(marked["doc_id"]) & (F.col(mark_key) == marked[key]), "left")
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda _, i: ~F.exists(mark, lambda g: (i >= g["start"]) & (i < g["start"] + g["n_lines"])))
    removed = F.coalesce(F.aggregate(mark, F.lit(0).cast("long"), lambda a, g: a + g["n_lines"]), F.lit(0).cast("long"))
    total = F.when(F.col("text").isNull() | (F.col("text") == ""), 0).otherwise(F.size(lines)).cast("long")
    return both.select(
        *[F.when(F.col(mark).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text") if c == "text" else F.col(c) for c in out_cols],
        total.alias("n_lines"), removed.alias("n_lines_removed"),
        F.when(F.col(mark).isNull(), 0).otherwise(F.size(mark)).cast("long").alias("n_chunks_removed"))


def passage_spans(docs: DataFrame, row: str, min_lines: int, min_words: int) -> DataFrame:
    """``docs`` (doc_id, text, ``row``) with one row per run of ``min_lines`` adjacent lines and per
    line of at least ``min_words`` words: _row, doc_id, doc_key, start, n_lines and two digests."""
    marks = F.transform(F.split("text", "\n", -1), lambda x: F.struct(
        F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), (words(x) >= min_words).alias("long")))
    marked = (docs.where(F.col("text").isNotNull() & (F.col("text") != ""))
              .select(F.col(row).alias("_row"), "doc_id", F.md5(F.col("text").cast("binary")).alias("doc_key"), marks.alias("_marks")))

    def span(i: Column, n: int) -> Column:
        digest = lambda part: F.xxhash64(F.lit(n), *[F.get("_marks", i + k)[part] for k in range(n)])
        return F.struct(i.alias("start"), F.lit(n).alias("n_lines"), digest("a").alias("h1"), digest("b").alias("h2"))

    every = F.sequence(F.lit(0), F.size("_marks") - 1)
    runs = F.transform(F.filter(every, lambda i: i <= F.size("_marks") - min_lines), lambda i: span(i, min_lines))
    longs = F.transform(F.filter(every, lambda i: F.get("_marks", i)["long"]), lambda i: span(i, 1))
    return marked.select("_row", "doc_id", "doc_key", F.explode(F.concat(runs, longs)).alias("s")).select("_row", "doc_id", "doc_key", "s.*")


def passage_dedup(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (doc_id, text, ...) without the passages that occurred before, and the columns
    n_lines, n_lines_removed, n_chunks_removed (runs of removed lines) as :func:`line_dedup` has them.

    A line goes when it lies in a run of ``min_lines`` adjacent lines, or is a line of at least
    ``min_words`` words, whose bytes occur at an earlier place (doc_id, then text hash, row, position).
    The earliest place of a line keeps it, so every line stays once.
    Rows that repeat both doc_id and text have a row number each, so all but one of them are copies."""
    out_cols = [c for c in docs.columns if c.lower() not in ("n_lines", "n_lines_removed", "n_chunks_removed")]
    row, mark, mark_row = (fresh_name(n, docs.columns) for n in ("_row", "_gone", "_gone_row"))
    docs = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "passages-rows")

    spans = passage_spans(docs, row, min_lines, min_words)
    repeated = (spans.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "doc_key", "_row", "start")).alias("first"), F.count("*").alias("n"))
                .where("n > 1").select("h1", "h2", "first"))
    repeated = materialize(repeated, "passages-repeated")
    is_first = (F.col("_row") == F.col("first._row")) & (F.col("start") == F.col("first.start"))
    hits = (spans.join(repeated, ["h1", "h2"]).groupBy("_row")
            .agg(F.collect_list(F.struct("start", "n_lines", "h1", "h2", is_first.alias("is_first"))).alias("_hits")))

    # only the bytes of spans with a repeated digest travel, to be compared with the first place's
    lined = docs.select(F.col(row).alias("_row"), F.split("text", "\n", -1).alias("_lines")).join(hits, "_row")
    taken = F.transform("_hits", lambda s: F.struct(
        s["start"].alias("start"), s["n_lines"].alias("n_lines"), s["h1"].alias("h1"), s["h2"].alias("h2"), s["is_first"].alias("is_first"),
        F.array_join(F.slice("_lines", s["start"] + 1, s["n_lines"]), "\n").alias("chunk")))
    hold = materialize(lined.select("_row", F.explode(taken).alias("s")).select("_row", "s.*"), "passages-spans")
    original = hold.where("is_first").select("h1", "h2", F.col("chunk").alias("first_chunk"))
    gone = (hold.where(~F.col("is_first")).join(original, ["h1", "h2"]).where(F.col("chunk") == F.col("first_chunk"))
            .select("_row", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n_lines") - 1)).alias("line"))
            .groupBy("_row").agg(F.collect_set("line").alias(mark)).withColumnRenamed("_row", mark_row))

    own = fresh_name("_lines", docs.columns)
    both = docs.join(gone, F.col(mark_row) == F.col(row), "left").withColumn(own, F.split("text", "\n", -1))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(own) - 1), F.col(mark)), lambda i: F.get(own, i))
    count = lambda c: F.when(F.col(mark).isNull(), 0).otherwise(F.size(c)).cast("long")
    return both.select(
        *[F.when(F.col(mark).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text") if c == "text" else F.col(c) for c in out_cols],
        F.when(F.col("text").isNull() | (F.col("text") == ""), 0).otherwise(F.size(own)).cast("long").alias("n_lines"),
        count(F.col(mark)).alias("n_lines_removed"),
        count(F.array_except(F.col(mark), F.transform(mark, lambda i: i + 1))).alias("n_chunks_removed"))
