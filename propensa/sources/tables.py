"""Parquet scans of the driver tables, pruned to the columns a caller needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table_file(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan one driver table; selecting ``columns`` up front keeps the
    parquet ReadSchema narrow even before Catalyst prunes."""
    df = spark.read.parquet(table_file(sf_dir, name))
    return df.select(*columns) if columns else df


def register_views(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> None:
    """Temp views named like the tables, for ``spark.sql`` users."""
    for name in names or TABLES:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
