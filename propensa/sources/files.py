"""Files of any Hadoop file system, by way of the session's own client: lists of
names, sizes and times, never contents."""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    p, fs = _fs(spark, pattern)
    return [s.getPath().toString() for s in (fs.globStatus(p) or [])]


def listed(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change) of a file or of all files below a folder; none if it is missing."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    out, found = [], fs.listFiles(p, True)
    while found.hasNext():
        s = found.next()
        out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return sorted(out)


def state(spark: SparkSession, *paths: str) -> str:
    """A short text that changes when a file below the paths is added, removed or rewritten."""
    return hashlib.md5(repr([listed(spark, p) for p in paths]).encode()).hexdigest()


def size(spark: SparkSession, path: str) -> int:
    return sum(n for _, n, _ in listed(spark, path))


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)
