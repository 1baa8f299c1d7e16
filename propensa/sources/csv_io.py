"""CSV seeds and file sinks.

Seeds are read either with a declared schema built from a ``{column: type}``
mapping (one pass) or with inferred types (an extra pass over the data, as
``read_csv_auto`` does).  Whitespace is preserved both ways: the raw layer
carries padded text on purpose and staging trims it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propensa.sources.csv_records import read_records

_TYPES = {
    "varchar": T.StringType(), "string": T.StringType(), "text": T.StringType(),
    "integer": T.IntegerType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
}

# whitespace is kept; quotes inside a quoted field are doubled (RFC 4180)
_KEEP_SPACES = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "quote": '"', "escape": '"'}


def schema_from_types(columns: dict[str, str], default: str = "varchar") -> T.StructType:
    """StructType from a declared ``{column: type}`` mapping."""
    return T.StructType([T.StructField(name, _TYPES[(kind or default).lower()], True)
                         for name, kind in columns.items()])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | dict[str, str] | None = None,
             declared: dict[str, str] | None = None, multiline: bool = False) -> DataFrame:
    """Header CSV scan.  With ``schema`` every type is declared, the header
    must name the same columns, and a value that is not of its type fails the
    read; without it the types are inferred (costs a second pass, avoid on
    large inputs), and ``declared`` then fixes the types of some columns
    (partial declaration, the remainder inferred).  ``multiline`` allows line
    breaks in quoted fields: with ``schema`` a file is still read by many tasks
    (``csv_records``), without it by one."""
    if schema is not None and multiline:
        return read_records(spark, path, schema_from_types(schema) if isinstance(schema, dict) else schema, _KEEP_SPACES)
    reader = spark.read.option("header", "true").option("multiLine", str(multiline).lower()).options(**_KEEP_SPACES)
    if schema is None:
        df = reader.option("inferSchema", "true").csv(path)
        if declared:
            df = df.select(*[F.col(c).cast(_TYPES[declared[c].lower()]).alias(c) if c in declared else F.col(c)
                             for c in df.columns])
        return df
    reader = reader.option("mode", "FAILFAST").option("enforceSchema", "false")
    return reader.schema(schema_from_types(schema) if isinstance(schema, dict) else schema).csv(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """Full-replace CSV write.  ``single_file`` only for results of a
    bounded size (a top-k list), never for a whole table."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", "true").options(**_KEEP_SPACES).csv(path)
    return path


def write_call_list(df: DataFrame, base_dir: str, list_date: dt.date | None = None) -> str:
    """Dated call-list sink: ``<base>/weekly_call_list_<yyyy-mm-dd>``.  The
    list has k rows, so it is written as one file."""
    list_date = list_date or dt.date.today()
    return write_csv(df, f"{base_dir.rstrip('/')}/weekly_call_list_{list_date.isoformat()}", single_file=True)


def write_json_record(df: DataFrame, path: str) -> str:
    """One-row record (metrics) as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


# Declared seed types (raw layer).  Keys are text: entity ids need not be numbers.
CLINICIAN_TYPES = {
    "clinician_id": "varchar", "signup_date": "varchar", "specialty": "varchar", "state": "varchar",
    "ehr_system": "varchar", "practice_size": "varchar", "org_type": "varchar",
    "annual_patient_volume": "bigint", "converted_to_enterprise": "integer", "conversion_date": "varchar",
}
USAGE_TYPES = {
    "clinician_id": "varchar", "snapshot_date": "varchar", "logins_per_week": "bigint",
    "days_since_last_login": "bigint", "team_members_invited": "bigint", "api_calls_per_week": "bigint",
    "features_used_count": "bigint", "support_tickets_l90d": "bigint", "video_consults_per_week": "bigint",
    "async_messages_per_week": "bigint", "days_on_platform": "bigint",
}
FIRMOGRAPHIC_TYPES = {
    "clinician_id": "varchar", "annual_patient_volume": "bigint", "revenue_band": "varchar",
    "num_locations": "integer", "has_billing_system": "integer", "accepts_insurance": "integer",
    "is_group_practice": "integer",
}
SEED_TYPES = {
    "clinicians": CLINICIAN_TYPES,
    "usage_metrics": USAGE_TYPES,
    "firmographic_enrichment": FIRMOGRAPHIC_TYPES,
}
