"""Plan shape: pushdown and pruning reach the scan, top-k never funnels the
whole table into one task, no Python UDF in the hot path, and the joins
on the bucketed seed table need no shuffle."""

from propensa.plans.pipeline import graph
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_call_list_plan(spark):
    g = graph(spark, SF_SMALL)
    plan = _plan(g["mart_weekly_call_list"])
    assert "TakeOrderedAndProject" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_joins_are_shuffle_free_on_bucketed_seed(spark):
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    prev_aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        g = graph(spark, SF_SMALL)
        plan = _plan(g["mart_conversion_features"])
        assert plan.count("SortMergeJoin") == 2
        assert "Exchange" not in plan
        from propensa.operators.quality import relationships
        fk = _plan(relationships(g["stg_usage_metrics"], g["stg_clinicians"]))
        assert "SortMergeJoin" in fk and "LeftAnti" in fk and "Exchange" not in fk
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        spark.conf.set("spark.sql.adaptive.enabled", prev_aqe)


def test_seed_scan_is_pruned(spark):
    from propensa.sources.seeds import customer_entities
    plan = customer_entities(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    # orders is read with only the five columns the aggregation needs
    assert "o_orderkey" not in plan
    assert "HashAggregate" in plan


def test_orders_aggregation_is_partial_before_shuffle(spark):
    """A hot customer collapses map-side: partial aggregates feed both
    exchanges, and the distinct count is planned without Expand."""
    from propensa.sources.seeds import orders_by_customer
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(orders_by_customer(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)
    assert "partial_min" in plan and "Expand" not in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_metrics_avoid_single_partition_window(spark):
    from pyspark.sql import functions as F

    from propensa.operators import metrics as M
    df = spark.range(2000).select((F.col("id") % 97).cast("double").alias("s"),
                                  (F.col("id") % 3 == 0).cast("int").alias("y"))
    plan = _plan(M.roc_auc(df, "s", "y"))
    # the only un-partitioned window runs on the per-range totals, after an aggregate
    assert "Window" in plan
    assert "BroadcastExchange" in plan


def test_eligibility_filter_reaches_the_scan(spark):
    g = graph(spark, SF_SMALL)
    df = g["mart_weekly_call_list"]
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(mode)
    assert "LessThanOrEqual(days_since_last_login,60)" in plan
    assert "GreaterThanOrEqual(days_on_platform,14)" in plan


def test_features_join_of_written_tables_is_shuffle_free(spark):
    from propensa.plans import models
    from propensa.plans.pipeline import run
    m = run(spark, SF_SMALL, suffix="_plantest")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    prev_aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        feats = models.features(m["int_clinician_firmographic_score"], m["int_clinician_engagement"])
        plan = _plan(feats)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        spark.conf.set("spark.sql.adaptive.enabled", prev_aqe)


def test_no_python_execution_in_any_registered_query(spark):
    """Every query of the scoring chain stays JVM-side: no Python UDF or
    pandas operator appears in any physical plan."""
    import __spark_entry__ as E
    python_nodes = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                    "MapInPandas", "AggregateInPandas", "FlatMapCoGroupsInPandas", "WindowInPandas")
    for name, fn in E.queries().items():
        if fn.__module__.startswith("propensa.llm"):
            continue
        plan = _plan(fn(spark, SF_SMALL))
        hits = [n for n in python_nodes if n in plan]
        assert not hits, f"{name}: {hits}"
