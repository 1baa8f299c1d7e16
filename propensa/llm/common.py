"""Small helpers shared by the operators: shared-folder tables and table scans."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from propensa.session import shared_dir

#: Bytes of text that are Python strings at once.
PART_BYTES = 4 << 20

_kept: dict[str, dict] = {}


def scan(spark: SparkSession, sf_dir: str, table: str, *cols: str) -> DataFrame:
    """The named columns of one input table."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*cols)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder (``spark.checkpoint.dir``)."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage is cut
    and a lost executor costs only the tasks it was running."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_name(base: str, taken: list[str]) -> str:
    """``base``, with underscores appended until no column of ``taken`` has it
    (column names compare without case, as Spark resolves them)."""
    low = {c.lower() for c in taken}
    while base.lower() in low:
        base += "_"
    return base


def arrow_rows(batch, *names):
    """The named columns of an Arrow batch as Python lists."""
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def worker_cache(owner: str) -> dict:
    """The table that ``owner`` keeps in this Python worker.  A worker serves one
    stage after another; it keeps the table of the operator it serves only."""
    if owner not in _kept:
        _kept.clear()
        _kept[owner] = {}
        pa.default_memory_pool().release_unused()
    return _kept[owner]


def text_parts(batch: pa.RecordBatch, column: int, limit: int = PART_BYTES) -> Iterator[tuple[pa.RecordBatch, list]]:
    """``batch`` in slices of consecutive rows with about ``limit`` bytes of text
    in ``column`` (one row at least), each with its texts."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(batch):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        part = batch.slice(at, to - at)
        yield part, part.column(column).to_pylist()
        at = to


def text_place(keep: tuple[str, ...]) -> tuple[int, list[str]]:
    """Place of ``text`` among the columns sent to Python: that among ``keep``, or
    else after them, with the columns to send in addition."""
    return (keep.index("text"), []) if "text" in keep else (len(keep), ["text"])


class Generations:
    """A bounded table of what was worked out for strings: two dictionaries, of which
    the older one goes when the younger has ``limit`` characters of keys.  Strings
    that are asked for again move to the younger one, so frequent ones stay."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old, self.chars = limit, {}, {}, 0

    def missing(self, wanted: set) -> list:
        """Make ``wanted`` present in ``young`` as far as known; the rest is returned."""
        if self.chars > self.limit:
            self.young, self.old, self.chars = {}, self.young, 0
        absent, old = wanted.difference(self.young), self.old
        again = {w: old[w] for w in absent if w in old}
        self.put_all(again)
        return list(absent.difference(again))

    def put(self, key, value) -> None:
        self.young[key] = value
        self.chars += len(key)

    def put_all(self, values: dict) -> None:
        """``put`` for several strings, none of which is in ``young``."""
        self.young.update(values)
        self.chars += sum(map(len, values))
