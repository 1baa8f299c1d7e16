"""Parallel reading of CSV files whose quoted fields hold line breaks.

A line break inside quotes does not end a record, so a reader that starts in the
middle of a file does not know whether it stands within a field.  Spark then reads
each file in one task.  Here a file is read in Spark's usual byte ranges:

1. Every range gives the number of quotes in its lines (quotes in a field are doubled,
   so an odd number before a place means that it is within a field), and its first line.
2. The driver adds up the parities range by range, one row for each range of the
   scan, which it has planned itself; a file must end outside of a field.
3. Every range reads its lines from its known state and gives its own records.  A
   record that crosses ranges gives a fragment in each of them; the fragments, two a
   range at most, are put together by one grouping.  That is a scan of its own and is left
   out if no range begins within a field.

The records are parsed by Spark's ``from_csv``.  The first record of every file is the
header and must name the declared columns.  As in RFC 4180, a quote may occur in
quoted fields only, with a quote in it doubled; a file that ends within a field
fails.  Lines end by LF or CR LF; empty lines between records are skipped.

Edge cases: a file of its header only, or an empty one, gives no rows; compressed
files are one range; if the ranges of two scans differ (the files were changed) the
read fails and has to be repeated.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE = '"'
#: Kinds of rows of the range reader: a record, the end, the middle and the begin of one that crosses ranges.
WHOLE, HEAD, MIDDLE, TAIL = range(4)
OUT = "kind int, file string, start long, text string"


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """(text, file, start) of every physical line; ``start`` is that of its byte range."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("value").alias("text"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def range_states(lines: DataFrame) -> tuple[dict[str, dict[int, bool]], set[str]]:
    """({file: {start of a range: whether it begins within a field}}, first lines of the files)."""
    odd = F.pmod(F.sum(F.length("text") - F.length(F.replace("text", F.lit(QUOTE)))), F.lit(2))
    first = F.when(F.col("start") == 0, F.min_by("text", "at"))
    rows = lines.withColumn("at", F.monotonically_increasing_id()).groupBy("file", "start").agg(odd.alias("odd"), first.alias("first")).collect()
    states: dict[str, dict[int, bool]] = {}
    inside: dict[str, bool] = {}
    for r in sorted(rows, key=lambda r: (r.file, r.start)):
        states.setdefault(r.file, {})[r.start] = inside.get(r.file, False)
        inside[r.file] = inside.get(r.file, False) ^ bool(r.odd)
    broken = [f for f, still in inside.items() if still]
    if broken:
        raise ValueError(f"{len(broken)} CSV files end within a quoted field, one is {broken[0]}")
    return states, {r.first.rstrip("\r") for r in rows if r.start == 0}


class RangeReader:
    """Records and fragments of consecutive lines of one range."""

    def __init__(self, file: str, start: int, inside: bool):
        self.file, self.start, self.inside = file, start, inside
        self.head = inside  # the record at hand began in an earlier range
        self.skip = start == 0  # the header
        self.open: list[str] = []

    def read(self, texts: pa.Array) -> Iterator[tuple[int, str]]:
        odd = pc.bit_wise_and(pc.count_substring(texts, QUOTE), 1).to_numpy(zero_copy_only=False).astype(bool)
        for text, flips in zip(texts.to_pylist(), odd.tolist()):
            was, self.inside = self.inside, self.inside ^ flips
            if was or self.inside:
                self.open.append(text)
                if self.inside:
                    continue
                text, self.open = "\n".join(self.open), []
            kind, self.head = (HEAD if self.head else WHOLE), False
            if self.skip:
                self.skip = False
            else:
                yield kind, text

    def plain(self, texts: pa.Array) -> bool:
        """Whether all lines are records of their own."""
        return not (self.inside or self.skip or self.head) and not pc.any(pc.match_substring(texts, QUOTE)).as_py()

    def rest(self) -> Iterator[tuple[int, str]]:
        if self.open:
            yield (MIDDLE if self.head else TAIL), "\n".join(self.open)


def range_records(lines: DataFrame, states: dict[str, dict[int, bool]]) -> DataFrame:
    """(kind, file, start, text) of all records and fragments."""
    sent = lines.sparkSession.sparkContext.broadcast(states)

    def out(reader: RangeReader, found: list[tuple[int, str]]) -> pa.RecordBatch:
        n = len(found)
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int32()), pa.array([reader.file] * n, pa.string()),
                                           pa.array([reader.start] * n, pa.int64()), pa.array([t for _, t in found], pa.string())], ["kind", "file", "start", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for batch in batches:
            texts, files, starts = batch.column(0), batch.column(1), batch.column(2).to_numpy()
            changes = np.flatnonzero((starts[1:] != starts[:-1]) | pc.not_equal(files[1:], files[:-1]).to_numpy(zero_copy_only=False)) + 1 if len(starts) else []
            for a, b in zip([0, *changes], [*changes, len(starts)]):
                file, start = files[int(a)].as_py(), int(starts[a])
                if reader is None or (reader.file, reader.start) != (file, start):
                    if reader is not None:
                        yield out(reader, list(reader.rest()))
                    state = sent.value.get(file, {}).get(start)
                    if state is None:
                        raise RuntimeError(f"the byte ranges of {file} differ between two scans; read it again")
                    reader = RangeReader(file, start, state)
                part = texts.slice(int(a), int(b - a))
                if reader.plain(part):
                    n = len(part)
                    yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, dtype=np.int32)), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), part.cast(pa.string())],
                                                     ["kind", "file", "start", "text"])
                else:
                    yield out(reader, list(reader.read(part)))
        if reader is not None:
            yield out(reader, list(reader.rest()))

    return lines.select("text", "file", "start").mapInArrow(run, OUT)


def put_together(fragments: DataFrame) -> DataFrame:
    """(text) of the records that cross ranges.  A range has two fragments at most."""
    place = Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = fragments.withColumn("record", F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(place))
    parts = F.sort_array(F.collect_list(F.struct("start", "kind", "text")))
    return numbered.groupBy("file", "record").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text")).select("text")


def record_texts(spark: SparkSession, path: str) -> tuple[DataFrame, set[str]]:
    """((text) of all records without the headers, distinct header lines)."""
    lines = lines_of(spark, path)
    states, headers = range_states(lines)
    every = range_records(lines, states)
    texts = every.where(F.col("kind") == WHOLE).select("text")
    if any(inside for ranges in states.values() for inside in ranges.values()):
        texts = texts.unionAll(put_together(every.where(F.col("kind") != WHOLE)))
    return texts, headers


def read_records(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """The records of the CSV files at ``path`` with the types of ``schema``; another
    header or a value that is not of its type fails."""
    texts, headers = record_texts(spark, path)
    for h in headers:
        names = next(csv.reader([h])) if h else []
        if names and names != schema.names:
            raise ValueError(f"the CSV header names {names}, declared are {schema.names}")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    text = F.regexp_replace("text", "\r$", "")
    rows = texts.select(text.alias("text")).where(F.col("text") != "")
    return rows.select(F.from_csv("text", ddl, {**options, "mode": "FAILFAST"}).alias("r")).select("r.*")
