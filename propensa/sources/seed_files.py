"""The three raw inputs from CSV files: ``clinicians.csv``, ``usage_metrics.csv``
and ``firmographic_enrichment.csv`` (each a file or a folder of files).

Each input is read once with its declared types (text keys; a malformed value
fails the read) and written as a raw table of its own, bucketed by the key, so
that the joins of the models need no exchange.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession

from propensa.session import buckets_for_rows, cores, session_key
from propensa.sources import catalog, csv_io, files

#: Bytes of a clinician's line at least: the files' size gives the number of rows, from above.
ROW_BYTES = 64

_buckets: dict[tuple, int] = {}


def seed_file(seeds_dir: str, name: str) -> str:
    return f"{seeds_dir.rstrip('/')}/{name}.csv"


def seeds_state(spark: SparkSession, seeds_dir: str) -> str:
    """State of the three inputs' files."""
    return files.state(spark, *[seed_file(seeds_dir, name) for name in csv_io.SEED_TYPES])


def raw_from_files(spark: SparkSession, seeds_dir: str) -> dict[str, str]:
    """Load the three files into bucketed raw tables (full replace); their names in ``raw``."""
    tag = hashlib.md5(seeds_dir.rstrip("/").encode()).hexdigest()[:10]
    buckets = buckets_for_rows(files.size(spark, seed_file(seeds_dir, "clinicians")) // ROW_BYTES, cores(spark))
    _buckets[(session_key(spark), seeds_dir.rstrip("/"))] = buckets
    for name, types in csv_io.SEED_TYPES.items():
        frame = csv_io.read_csv(spark, seed_file(seeds_dir, name), types, multiline=True)
        catalog.as_table(frame, "raw", f"{name}_{tag}", buckets=buckets)
    return {name: f"{name}_{tag}" for name in csv_io.SEED_TYPES}


def file_buckets(spark: SparkSession, seeds_dir: str) -> int | None:
    return _buckets.get((session_key(spark), seeds_dir.rstrip("/")))
