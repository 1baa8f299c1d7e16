"""Layer namespaces and materialisations (views and tables).

Layers map to catalog databases (``raw``, ``staging``, ``intermediate``,
``marts``) whose files live in the shared checkpoint folder.

A view is a persistent catalog view, a query text over other layers.  A table is a
full-replace parquet write, optionally bucketed by the entity key so later joins on
it skip the shuffle.  Every write is a version, a folder of its own below the table's:
the catalog entry is moved to it once the write is complete, in one step if
schema and buckets are those of before (else the entry is made anew).  Whoever reads
the former version goes on reading its files; the newest ``KEPT_VERSIONS`` folders stay.
Other applications find the newest complete version by the mark that Spark leaves
in a folder it has finished.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from propensa import rules
from propensa.session import default_buckets, session_key, table_path
from propensa.sources import files

#: Complete versions of a table that are kept, the current one included.
KEPT_VERSIONS = 3


def layer_name(custom: str | None, default: str = "default") -> str:
    """Namespace of a model: its configured layer name, trimmed, or the
    default database when none is configured."""
    if custom is None or not str(custom).strip():
        return default
    return str(custom).strip()


_made: set[tuple[str, str]] = set()


def ensure_layers(spark: SparkSession, layers: list[str] | None = None) -> list[str]:
    """Create the layer databases (once per session) in the shared folder."""
    made = []
    for layer in layers or rules.LAYERS:
        key = (session_key(spark), layer)
        if key not in _made or not spark.catalog.databaseExists(layer):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{table_path(spark, layer + '.db')}'")
            _made.add(key)
        made.append(layer)
    return made


def as_view(spark: SparkSession, layer: str, name: str, query: str) -> DataFrame:
    """View materialisation: nothing is computed; consumers inline the plan."""
    layer = layer_name(layer)
    ensure_layers(spark, [layer])
    spark.sql(f"CREATE OR REPLACE VIEW {layer}.{name} AS {query}")
    return spark.table(f"{layer}.{name}")


def versions(spark: SparkSession, layer: str, name: str) -> list[str]:
    """Folders of the complete versions of a table, newest first."""
    done = files.matching(spark, f"{table_path(spark, layer, name)}/v*/_SUCCESS")
    return sorted((p.rsplit("/", 1)[0] for p in done), reverse=True)


def stored(spark: SparkSession, layer: str, name: str) -> DataFrame:
    """The newest complete version of a table that this or another application wrote."""
    found = versions(spark, layer, name)
    if not found:
        raise FileNotFoundError(f"no table {layer}.{name} below {table_path(spark, layer)}")
    return spark.read.parquet(found[0])


def _layout(spark: SparkSession, full: str) -> tuple:
    rows = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {full}").collect()}
    return (spark.table(full).schema.json(), rows.get("Num Buckets"), rows.get("Bucket Columns"))


def as_table(df: DataFrame, layer: str, name: str, bucket_key: str | None = "clinician_id",
             buckets: int | None = None) -> DataFrame:
    """Table materialisation, full replace.  With ``bucket_key`` the rows
    are hash-partitioned on the key once and written one file per bucket.
    Buckets are not sorted on write: sort-merge joins sort bucket files at
    read time anyway (bucket sort order is not used by the planner)."""
    spark = df.sparkSession
    layer = layer_name(layer)
    ensure_layers(spark, [layer])
    full, mark = f"{layer}.{name}", uuid.uuid4().hex[:8]
    old = versions(spark, layer, name)
    number = 1 + (int(old[0].rsplit("/v", 1)[1].split("-")[0]) if old else 0)
    path = f"{table_path(spark, layer, name)}/v{number:08d}-{mark}"
    writer = df.write
    if bucket_key:
        n = buckets or default_buckets(spark)
        writer = df.repartition(n, bucket_key).write.bucketBy(n, bucket_key)
    new = f"{full}__{mark}"
    writer.format("parquet").option("path", path).saveAsTable(new)
    exists = spark.catalog.tableExists(full)
    if exists and _layout(spark, full) == _layout(spark, new):
        spark.sql(f"ALTER TABLE {full} SET LOCATION '{path}'")
        spark.sql(f"DROP TABLE {new}")  # the entry; its files stay
    else:
        if exists:
            spark.sql(f"DROP TABLE {full}")
        spark.sql(f"ALTER TABLE {new} RENAME TO {full}")
    spark.catalog.refreshTable(full)
    for gone in versions(spark, layer, name)[KEPT_VERSIONS:]:
        files.remove(spark, gone)
    return spark.table(full)


def ref(spark: SparkSession, layer: str, name: str) -> DataFrame:
    """Scan of an upstream model (table or view) by name."""
    return spark.table(f"{layer_name(layer)}.{name}")
