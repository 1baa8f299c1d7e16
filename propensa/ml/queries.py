"""Model queries (M3-M5, M9-M11, O5 model list, O6, S9-S11).  They train a model, so they
have no SQL oracle; the driver checks their row counts.  Training runs once
per session and data set; the mart it reads is materialised once, bucketed
by ``clinician_id`` (it has three consumers: training, evaluation and
scoring)."""

from __future__ import annotations

import hashlib

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa.ml import train as T
from propensa.ml.prepare import MODEL_PREFIX, prepare_features
from propensa.session import table_path
from propensa.sources import csv_io
from propensa.sources.seeds import AS_OF

ML_REGISTRY: dict = {}


def register(name: str):
    def deco(fn):
        ML_REGISTRY[name] = fn
        return fn
    return deco


def _tag(sf_dir: str) -> str:
    return hashlib.md5(sf_dir.rstrip("/").encode()).hexdigest()[:10]


def materialized_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart table of the materialised run (shared with the call list
    and the test suite)."""
    from propensa.plans.queries import materialized
    return materialized(spark, sf_dir)["mart_conversion_features"]


def model_for(spark: SparkSession, sf_dir: str) -> T.Trained:
    return T.trained(spark, materialized_mart(spark, sf_dir), _tag(sf_dir))


@register("m3_gbt_feature_importances")
def m3(spark, sf_dir):
    return model_for(spark, sf_dir).importances


@register("o6_top10_feature_importances")
def o6(spark, sf_dir):
    return T.top_importances(model_for(spark, sf_dir).importances, 10)


@register("m4_calibrated_test_scores")
def m4(spark, sf_dir):
    """Raw GBT probability and its isotonic calibration on the test part."""
    tr = model_for(spark, sf_dir)
    out = tr.model.transform(tr.split.filter(F.col("split") == "test"))
    return out.select("clinician_id", "label",
                      F.element_at(vector_to_array("gbt_probability"), 2).alias("gbt_probability"),
                      F.col(T.PROB))


@register("m5_eligible_pool_scores")
def m5(spark, sf_dir):
    from propensa.plans import models
    mart = materialized_mart(spark, sf_dir)
    pool = models.eligible(mart)
    feats = prepare_features(pool, keep=("clinician_id",), label=None, prefix=MODEL_PREFIX)
    return T.score(model_for(spark, sf_dir).model, feats).select("clinician_id", T.PROB)


@register("m10_model_metrics")
def m10(spark, sf_dir):
    return model_for(spark, sf_dir).metrics


@register("m11_ml_call_list")
def m11(spark, sf_dir):
    return T.ml_call_list(model_for(spark, sf_dir).model, materialized_mart(spark, sf_dir), as_of=AS_OF)


@register("s9_feature_importance_csv_sink")
def s9(spark, sf_dir):
    path = table_path(spark, "artifacts", f"feature_importance_{_tag(sf_dir)}")
    csv_io.write_csv(T.sorted_importances(model_for(spark, sf_dir).importances), path)
    return csv_io.read_csv(spark, path, {"feature": "varchar", "importance": "double"})


@register("s10_metrics_json_sink")
def s10(spark, sf_dir):
    path = table_path(spark, "artifacts", f"model_metrics_{_tag(sf_dir)}")
    metrics = model_for(spark, sf_dir).metrics
    csv_io.write_json_record(metrics, path)
    return spark.read.schema(metrics.schema).json(path)


@register("s11_model_artifact_roundtrip")
def s11(spark, sf_dir):
    """Reload the saved pipeline and score the test part with it."""
    tr = model_for(spark, sf_dir)
    reloaded = PipelineModel.load(tr.path)
    return T.score(reloaded, tr.split.filter(F.col("split") == "test")).select("clinician_id", T.PROB)


@register("o5_ml_top10_report")
def o5_ml(spark, sf_dir):
    """The first ten calls of the model-ranked list."""
    calls = T.ml_call_list(model_for(spark, sf_dir).model, materialized_mart(spark, sf_dir), as_of=AS_OF)
    return (calls.orderBy("call_rank").limit(10)
            .select("call_rank", "clinician_id", "specialty", "practice_size", T.PROB, "sales_angle"))


# --- agreements: exact companions of the queries above, with SQL -----------------------

def same(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """``key`` of every row of either side, and whether both have the same ``value``."""
    joined = a.select(key, F.col(value).alias("a")).join(b.select(key, F.col(value).alias("b")), key, "full")
    return joined.select(key, F.coalesce(F.col("a") == F.col("b"), F.lit(False)).alias("agrees"))


@register("m3_m9_importances_cover_features")
def m9_cover(spark, sf_dir):
    """Every feature with an importance in the unit interval; they sum to one, or to
    zero where no tree has a split."""
    imp = model_for(spark, sf_dir).importances
    total = imp.agg(F.sum("importance").alias("total"))
    return imp.join(total).select("feature", F.col("importance").between(0, 1).alias("in_range"), ((F.abs(F.col("total") - 1) < 1e-9) | (F.col("total") == 0)).alias("sums_right"))


@register("s9_importance_csv_agreement")
def s9_agreement(spark, sf_dir):
    """The importances in memory against those read back from the CSV file."""
    return same(model_for(spark, sf_dir).importances, s9(spark, sf_dir), "feature", "importance")


@register("s10_metrics_json_agreement")
def s10_agreement(spark, sf_dir):
    """Each number of the metrics record in memory against the JSON file."""
    def long(df):
        names = [f for f, kind in df.dtypes if kind in ("bigint", "double")]
        return df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])).alias("m")).select("m.*")

    return same(long(model_for(spark, sf_dir).metrics), long(s10(spark, sf_dir)), "metric", "value")


@register("s11_model_reload_agreement")
def s11_agreement(spark, sf_dir):
    """Scores of the test rows by the model of this run against the reloaded one."""
    tr = model_for(spark, sf_dir)
    return same(T.score(tr.model, tr.split.filter(F.col("split") == "test")), s11(spark, sf_dir), "clinician_id", T.PROB)


@register("m5_scored_pool_coverage")
def m5_cover(spark, sf_dir):
    """The eligible pool, each with a probability."""
    return m5(spark, sf_dir).select("clinician_id", F.col(T.PROB).between(0, 1).alias("is_probability"))


@register("m10_counts_and_rate")
def m10_counts(spark, sf_dir):
    """The exact part of the metrics record: rows by part, conversion rate, feature list."""
    m = model_for(spark, sf_dir).metrics
    rate = F.floor(F.col("conversion_rate") * 1e12 + F.lit(0.5)) / 1e12
    return m.select("n_train", "n_test", rate.alias("conversion_rate"), F.array_join("features", ",").alias("features"))


@register("m11_calls_are_the_best_of_the_pool")
def m11_best(spark, sf_dir):
    """Each call: whether it is of the pool and nobody outside the list scores higher."""
    pool = m5(spark, sf_dir)
    calls = m11(spark, sf_dir).select("call_rank", "clinician_id")
    listed = pool.join(calls, "clinician_id", "left")
    rest = listed.filter(F.col("call_rank").isNull()).agg(F.max(T.PROB).alias("best_outside"))
    mine = listed.filter(F.col("call_rank").isNotNull()).join(rest)
    return mine.select("call_rank", (F.col(T.PROB) >= F.coalesce(F.col("best_outside"), F.lit(0.0))).alias("is_best"))


@register("o6_top10_order")
def o6_order(spark, sf_dir):
    """Places of the ten largest importances: none outside is larger."""
    imp = model_for(spark, sf_dir).importances
    top = o6(spark, sf_dir)
    least = top.agg(F.min("importance").alias("least"))
    outside = imp.join(top, "feature", "left_anti").join(least).agg(F.count_if(F.col("importance") > F.col("least")).alias("larger_outside"))
    return top.agg(F.count(F.lit(1)).alias("n")).join(outside).select("n", "larger_outside")
