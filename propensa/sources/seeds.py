"""Raw seed layer: the three logical inputs (clinicians, usage snapshot,
firmographic enrichment) derived from the driver tables.

One entity is one customer.  Everything the three seeds need from
``orders`` comes out of a single per-customer aggregation (partial hash
aggregation on the map side, so a customer holding a third of all orders
costs one partial row per map task).  The joined entity table is written
once, bucketed by ``clinician_id``, into the shared checkpoint folder; the
three seeds are projections of it.  Because every later join is on
``clinician_id``, the bucketed scan makes those joins shuffle-free.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa.session import buckets_for_rows, cores, session_key, set_bucket_hint
from propensa.sources import files
from propensa.sources.catalog import as_table, as_view, ref
from propensa.sources.tables import read_table

# Fixed snapshot date of the driver data (orders run up to 2001-08-01).
AS_OF = dt.date(2001, 8, 2)

CLINICIAN_COLS = [
    "clinician_id", "signup_date", "specialty", "state", "ehr_system", "practice_size",
    "org_type", "annual_patient_volume", "converted_to_enterprise", "conversion_date",
]
USAGE_COLS = [
    "clinician_id", "snapshot_date", "logins_per_week", "days_since_last_login",
    "team_members_invited", "api_calls_per_week", "features_used_count",
    "support_tickets_l90d", "video_consults_per_week", "async_messages_per_week",
    "days_on_platform",
]
FIRMOGRAPHIC_COLS = [
    "clinician_id", "annual_patient_volume", "revenue_band", "num_locations",
    "has_billing_system", "accepts_insurance", "is_group_practice",
]

# Fixed values of the binding from driver tables to the three inputs.
SEGMENT_TO_SPECIALTY = {
    "BUILDING": "Oncology",
    "AUTOMOBILE": "Psychiatry",
    "MACHINERY": "Primary Care",
    "HOUSEHOLD": "Orthopedics",
}
REGION_TO_EHR = {"AFRICA": "Epic", "AMERICA": "Cerner", "ASIA": "DrChrono", "EUROPE": "None"}
UNMAPPED = "Unmapped"
# (upper bound of c_acctbal, label); the last label takes everything above.
ACCTBAL_TO_PRACTICE_SIZE = [
    (1000, "Solo"), (4000, "Small (2-10)"), (7000, "Medium (11-50)"), (9000, "Large (51-200)"),
]
ACCTBAL_TO_REVENUE_BAND = [(0, "<$1M"), (3000, "$1M-$5M"), (6000, "$5M-$20M"), (8500, "$20M-$100M")]
CONVERSION_MIN_PRICE = 480000
LOGIN_WINDOW_DAYS = 1000
RECENT_WINDOW_DAYS = 365
API_CALLS_PER_ORDER = 180
PRICE_BAND_WIDTH = 50000
VOLUME_DIVISOR = 5
CONVERSION_LAG_DAYS = 30
LOCATION_SPREAD = 6

_written: dict[tuple, str] = {}
_buckets: dict[tuple, int] = {}
_lock = threading.Lock()


def _lookup(col: Column, mapping: dict, default: str) -> Column:
    out = None
    for key, value in mapping.items():
        out = (F.when(col == key, value) if out is None else out.when(col == key, value))
    return out.otherwise(default)


def _threshold_label(col: Column, bounds: list[tuple], last: str) -> Column:
    out = None
    for bound, label in bounds:
        out = F.when(col < bound, label) if out is None else out.when(col < bound, label)
    return out.otherwise(last)


def orders_by_customer(spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF) -> DataFrame:
    """One row per ordering customer with every order statistic the seeds use."""
    o = read_table(spark, sf_dir, "orders",
                   ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
    odate = F.to_date("o_orderdate")
    age = F.datediff(F.lit(as_of), odate)
    status, prio, price = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")
    return o.groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.min(odate).alias("first_order"),
        F.max(F.when((price > CONVERSION_MIN_PRICE) & (status == "O"), 1).otherwise(0)).alias("converted"),
        # exact decimal sum: the same total whatever the partitioning
        F.sum(F.when(status == "F", price.cast("decimal(15,2)"))).alias("finished_total"),
        F.count(F.when(status == "F", 1)).alias("n_finished"),
        F.count(F.when(status == "O", 1)).alias("n_open"),
        F.count(F.when(age <= LOGIN_WINDOW_DAYS, 1)).alias("logins"),
        F.min(age).alias("min_age"),
        F.max(age).alias("max_age"),
        F.count(F.when(prio == "1-URGENT", 1)).alias("urgent"),
        F.count(F.when((prio == "2-HIGH") & (age <= RECENT_WINDOW_DAYS), 1)).alias("high_recent"),
        F.count_distinct(F.floor(price / PRICE_BAND_WIDTH)).alias("price_bands"),
        F.count(F.when((status == "P") & (age <= RECENT_WINDOW_DAYS), 1)).alias("pending_recent"),
        F.count(F.when(prio == "3-MEDIUM", 1)).alias("medium"),
        F.count(F.when(prio == "4-NOT SPECIFIED", 1)).alias("unspecified"),
    )


def customer_entities(spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF) -> DataFrame:
    """Lazy plan of the entity table: every raw column of the three seeds
    plus the two coverage flags that decide seed membership."""
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    # nation and region are dimension tables of fixed size; Spark broadcasts
    # them by its own size check (autoBroadcastJoinThreshold).
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")
    stats = orders_by_customer(spark, sf_dir, as_of)
    e = (customer.join(geo, customer.c_nationkey == geo.n_nationkey, "left")
         .join(stats, customer.c_custkey == stats.custkey, "left"))

    practice = _threshold_label(F.col("c_acctbal"), ACCTBAL_TO_PRACTICE_SIZE, "Enterprise (200+)")
    converted = F.coalesce(F.col("converted"), F.lit(0))
    volume = F.floor(F.col("finished_total") / VOLUME_DIVISOR).cast("bigint")
    snapshot = F.lit(as_of.isoformat())
    return e.select(
        F.col("c_custkey").alias("clinician_id"),
        # clinicians (raw text dates, 0/1 label)
        F.date_format("first_order", "yyyy-MM-dd").alias("signup_date"),
        _lookup(F.col("c_mktsegment"), SEGMENT_TO_SPECIALTY, UNMAPPED).alias("specialty"),
        F.col("n_name").alias("state"),
        _lookup(F.col("r_name"), REGION_TO_EHR, UNMAPPED).alias("ehr_system"),
        practice.alias("practice_size"),
        F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ")).alias("org_type"),
        volume.alias("annual_patient_volume"),
        converted.cast("int").alias("converted_to_enterprise"),
        F.when(converted == 1, F.date_format(F.date_add("first_order", CONVERSION_LAG_DAYS), "yyyy-MM-dd"))
        .alias("conversion_date"),
        # usage snapshot
        snapshot.alias("snapshot_date"),
        F.col("logins").alias("logins_per_week"),
        F.floor(F.col("min_age") / 8).cast("bigint").alias("days_since_last_login"),
        F.col("urgent").alias("team_members_invited"),
        (F.col("high_recent") * API_CALLS_PER_ORDER).alias("api_calls_per_week"),
        F.greatest(F.lit(1), F.col("price_bands")).cast("bigint").alias("features_used_count"),
        F.col("pending_recent").alias("support_tickets_l90d"),
        F.col("medium").alias("video_consults_per_week"),
        F.col("unspecified").alias("async_messages_per_week"),
        F.col("max_age").cast("bigint").alias("days_on_platform"),
        # firmographic enrichment
        _threshold_label(F.col("c_acctbal"), ACCTBAL_TO_REVENUE_BAND, "$100M+").alias("revenue_band"),
        (F.lit(1) + F.col("c_nationkey") % LOCATION_SPREAD).alias("num_locations"),
        (F.col("c_acctbal") > 0).cast("int").alias("has_billing_system"),
        (F.col("c_nationkey") % 2 == 0).cast("int").alias("accepts_insurance"),
        (practice != "Solo").cast("int").alias("is_group_practice"),
        # seed membership: telemetry exists for accounts with an open order,
        # enrichment for accounts with a finished order
        (F.coalesce(F.col("n_open"), F.lit(0)) > 0).alias("has_usage"),
        (F.coalesce(F.col("n_finished"), F.lit(0)) > 0).alias("has_firmographics"),
    )


def _tag(sf_dir: str, as_of: dt.date, buckets: int) -> str:
    return hashlib.md5(f"{sf_dir.rstrip('/')}|{as_of}|{buckets}".encode()).hexdigest()[:10]


def materialize_entities(spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF,
                         buckets: int | None = None) -> str:
    """Write the entity table into the shared folder, once per session and state
    of the input files, bucketed by ``clinician_id``; returns the catalog name.  The bucket
    count follows the entity count (a parquet metadata count of
    ``customer``): at most about a million entities per bucket, at least
    one bucket per task slot."""
    if not buckets:
        buckets = _buckets.get((session_key(spark), sf_dir.rstrip("/"))) or buckets_for_rows(
            read_table(spark, sf_dir, "customer", ["c_custkey"]).count(), cores(spark))
    _buckets[(session_key(spark), sf_dir.rstrip("/"))] = buckets
    set_bucket_hint(spark, buckets)
    tag = _tag(sf_dir, as_of, buckets)
    name = f"raw.seed_entities_{tag}"
    key, now = (session_key(spark), tag), input_state(spark, sf_dir)
    with _lock:
        if _written.get(key) != now or not spark.catalog.tableExists(name):
            as_table(customer_entities(spark, sf_dir, as_of), "raw", f"seed_entities_{tag}", buckets=buckets)
            _written[key] = now
    return name


def input_state(spark: SparkSession, sf_dir: str) -> str:
    """State of the driver tables the seeds are made of."""
    return files.state(spark, *[f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("customer", "nation", "region", "orders")])


def seed_buckets(spark: SparkSession, sf_dir: str) -> int | None:
    """Bucket count of this data set's entity table (tables derived from it
    use the same count, so joins between them stay co-located)."""
    return _buckets.get((session_key(spark), sf_dir.rstrip("/")))


#: raw input -> (its columns, condition on the entity table)
INPUTS = {
    "clinicians": (CLINICIAN_COLS, "true"),
    "usage_metrics": (USAGE_COLS, "has_usage"),
    "firmographic_enrichment": (FIRMOGRAPHIC_COLS, "has_firmographics"),
}


def raw_views(spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF) -> dict[str, str]:
    """The three raw seeds as views of the bucketed entity table; their names in ``raw``."""
    table = materialize_entities(spark, sf_dir, as_of)
    tag = table.rsplit("_", 1)[1]
    for name, (cols, condition) in INPUTS.items():
        as_view(spark, "raw", f"{name}_{tag}", f"SELECT {', '.join(cols)} FROM {table} WHERE {condition}")
    return {name: f"{name}_{tag}" for name in INPUTS}


def raw_inputs(spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF) -> dict[str, DataFrame]:
    """The three raw seeds, as projections of the bucketed entity table."""
    return {name: ref(spark, "raw", view) for name, view in raw_views(spark, sf_dir, as_of).items()}


__all__ = [
    "AS_OF", "CLINICIAN_COLS", "USAGE_COLS", "FIRMOGRAPHIC_COLS", "orders_by_customer",
    "customer_entities", "input_state", "materialize_entities", "raw_inputs", "raw_views", "seed_buckets",
]
