"""A hot key: one customer holds a third of all orders.  The pipeline must
give the same results as the SQL oracle on such data (AQE skew handling
on), with no row dropped or capped."""

import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from propensa.session import table_path
from tests.test_oracle import _canon

CHECKED = [
    "p2_stg_usage_metrics", "d16_int_clinician_firmographic_score", "d18_mart_conversion_features",
    "d19_weekly_call_list", "q9_test_suite", "a8_mart_summary", "m2_stratified_split",
    "m6_roc_auc_baseline", "m7_average_precision_baseline",
]


@pytest.fixture(scope="module")
def skewed_dir(spark):
    base = table_path(spark, "tests", "skew_" + uuid.uuid4().hex)
    regions = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    spark.createDataFrame(list(enumerate(regions)), "r_regionkey int, r_name string") \
        .write.parquet(f"{base}/region.parquet")
    spark.range(25).select(F.col("id").cast("int").alias("n_nationkey"),
                           F.concat(F.lit("NATION_"), F.col("id")).alias("n_name"),
                           (F.col("id") % 5).cast("int").alias("n_regionkey")) \
        .write.parquet(f"{base}/nation.parquet")
    h = lambda c, salt: F.abs(F.xxhash64(F.col(c), F.lit(salt)))
    segs = F.array(*[F.lit(s) for s in ["BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD", "FURNITURE"]])
    spark.range(400).select(
        F.col("id").alias("c_custkey"), F.concat(F.lit("Customer#"), F.col("id")).alias("c_name"),
        (h("id", 1) % 25).cast("int").alias("c_nationkey"),
        ((h("id", 2) % 1100000) / 100.0 - 1000.0).alias("c_acctbal"),
        F.element_at(segs, (h("id", 3) % 5 + 1).cast("int")).alias("c_mktsegment"),
    ).write.parquet(f"{base}/customer.parquet")
    statuses = F.array(F.lit("O"), F.lit("F"), F.lit("P"))
    prios = F.array(*[F.lit(p) for p in ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]])
    n = 12000
    spark.range(n).select(
        F.col("id").alias("o_orderkey"),
        # every third order belongs to customer 7
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(h("id", 4) % 400).cast("bigint").alias("o_custkey"),
        F.element_at(statuses, (h("id", 5) % 3 + 1).cast("int")).alias("o_orderstatus"),
        (1000.0 + (h("id", 6) % 49900000) / 100.0).alias("o_totalprice"),
        F.expr("to_timestamp_ntz(date_add(DATE'1995-01-01', cast(abs(xxhash64(id, 7)) % 2404 as int)))")
        .alias("o_orderdate"),
        F.element_at(prios, (h("id", 8) % 5 + 1).cast("int")).alias("o_orderpriority"),
    ).write.parquet(f"{base}/orders.parquet")
    return base


@pytest.fixture(scope="module")
def skew_con(skewed_dir):
    import duckdb
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "orders"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{skewed_dir.replace('file:', '')}/{t}.parquet/*.parquet')")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_hot_key_matches_oracle(spark, skewed_dir, skew_con, name):
    df = E.queries()[name](spark, skewed_dir)
    rows = [tuple(r) for r in df.collect()]
    cur = skew_con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert _canon(df.columns, rows) == _canon(cols, cur.fetchall())


def test_hot_customer_keeps_all_orders(spark, skewed_dir):
    from propensa.sources.seeds import orders_by_customer
    orders = spark.read.parquet(f"{skewed_dir}/orders.parquet").filter("o_custkey = 7")
    assert orders.count() >= 4000
    hot = orders_by_customer(spark, skewed_dir).filter("custkey = 7").collect()[0]
    assert hot.n_open == orders.filter("o_orderstatus = 'O'").count()
    assert hot.n_finished == orders.filter("o_orderstatus = 'F'").count()
