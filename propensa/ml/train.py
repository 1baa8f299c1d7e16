"""Train, calibrate, evaluate and score.

* M3: boosted trees on the train part, ended by a patience window over the loss
  of the validation part (``ml.boosting``).  Trees are grown level by
  level across executors (one histogram aggregation per level, ``ml.trees``).
* M4: isotonic calibration of the GBT probability, fitted on all rows of its own
  calibration part (not on the rows it is evaluated on).
* M6-M8 on the untouched test part, through the distributed metrics in
  ``operators.metrics``.
* The fitted stages form one ``PipelineModel`` (buckets -> assembler -> GBT ->
  isotonic) that is saved and loaded as a whole.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import threading
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa import rules
from propensa.functions.scoring import sales_angle
from propensa.ml.boosting import boost, bucketizer
from propensa.ml.prepare import BUCKET_PREFIX, MODEL_PREFIX, assembler, prepare_features
from propensa.ml.split import assign_split
from propensa.operators import metrics as M
from propensa.operators.isotonic import isotonic_blocks, isotonic_model
from propensa.operators.rank import score_order, top_k
from propensa.plans import models
from propensa.sources import catalog
from propensa.session import session_key, shared_dir, table_path

PROB = "ml_conversion_probability"


@dataclass
class Trained:
    model: PipelineModel
    path: str
    metrics: DataFrame
    importances: DataFrame
    split: DataFrame


def split_frame(mart: DataFrame) -> DataFrame:
    """Prepared (prefixed) features + label + split column."""
    return assign_split(prepare_features(mart, prefix=MODEL_PREFIX))


def _split(df: DataFrame) -> DataFrame:
    """Accepts the mart or an already split frame."""
    return df if "split" in df.columns else split_frame(df)


def calibrate(scored: DataFrame) -> IsotonicRegressionModel:
    """Isotonic fit of ``label`` on ``gbt_probability`` over all rows."""
    p = vector_to_array("gbt_probability")[1]
    blocks = isotonic_blocks(M.score_counts(scored.select(p.alias("p"), "label"), "p", "label"))
    return isotonic_model(blocks, "gbt_probability", PROB, lambda p: array_to_vector(F.array(1 - p, p)), 1)


def fit(mart: DataFrame, params: dict | None = None) -> tuple[PipelineModel, list[float]]:
    """Fit trees + calibration on the mart (or on its materialised split)."""
    spark = mart.sparkSession
    shared_dir(spark)  # boosting checkpoints go to the shared folder
    params = {**rules.GBT_PARAMS, **(params or {})}
    data = _split(mart)
    patience, tolerance = params.pop("patience"), params.pop("tolerance")
    train = data.filter(F.col("split") == "train")
    cols = [MODEL_PREFIX + c for c in rules.FEATURE_COLS]
    buckets = bucketizer(train, cols, [BUCKET_PREFIX + c for c in rules.FEATURE_COLS], params["maxBins"], "clinician_id", train.count())
    vec = assembler(prefix=BUCKET_PREFIX)
    boosted = vec.transform(buckets.transform(data.filter(F.col("split").isin("train", "validation"))))
    gbt_model, _ = boost(boosted, params, patience, tolerance, features="features", columns={
        "featuresCol": "features", "predictionCol": "gbt_prediction", "probabilityCol": "gbt_probability", "rawPredictionCol": "gbt_raw"})
    stages = [buckets, vec, gbt_model]
    iso = calibrate(PipelineModel(stages=stages).transform(data.filter(F.col("split") == "calibration")))
    return PipelineModel(stages=[*stages, iso]), list(gbt_model.featureImportances.toArray())


def boosted_part(model: PipelineModel) -> GBTClassificationModel:
    return next(s for s in model.stages if isinstance(s, GBTClassificationModel))


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M5: adds the calibrated probability; helper columns are dropped."""
    out = model.transform(df)
    return out.drop("features", "gbt_raw", "gbt_probability", "gbt_prediction",
                    *[p + c for p in (MODEL_PREFIX, BUCKET_PREFIX) for c in rules.FEATURE_COLS])


def evaluate(model: PipelineModel, mart: DataFrame) -> DataFrame:
    """One-row metrics record.  AUC and AP of the train and test part come out of one
    grouped pass; precision@80 is computed on the test part."""
    data = _split(mart)
    # scored once, written to the shared checkpoint folder, read by all metrics
    scored = score(model, data).select("clinician_id", "label", "split", PROB).checkpoint(eager=True)
    parts = (scored.filter(F.col("split") != "calibration")
             .withColumn("part", F.when(F.col("split") == "test", "test").otherwise("train")))
    test = scored.filter(F.col("split") == "test")

    def stacked(df: DataFrame, *metrics) -> DataFrame:
        """(name column, value column) pairs -> (metric, v) rows."""
        return df.select(F.explode(F.array(*[
            F.struct(name.alias("metric"), value.cast("double").alias("v")) for name, value in metrics
        ])).alias("m")).select("m.metric", "m.v")

    ranking = M.ranking_metrics(parts, PROB, "label", groups=["part"])
    long = (stacked(ranking, (F.concat(F.col("part"), F.lit("_auc_roc")), F.col("roc_auc")),
                    (F.concat(F.col("part"), F.lit("_avg_precision")), F.col("average_precision")),
                    (F.concat(F.lit("n_"), F.col("part")), F.col("n")))
            .unionByName(stacked(M.precision_at_k(test, PROB, "label", rules.TOP_K_METRIC),
                                 (F.lit("precision_at_top_80"), F.col("precision_at_k"))))
            .unionByName(stacked(scored.agg(F.avg(F.col("label").cast("double")).alias("r")),
                                 (F.lit("conversion_rate"), F.col("r")))))
    # (metric, value) rows folded into one row: no join needed
    order = ["train_auc_roc", "test_auc_roc", "test_avg_precision", "precision_at_top_80",
             "n_train", "n_test", "conversion_rate"]
    pick = {n: F.max(F.when(F.col("metric") == n, F.col("v"))) for n in order}
    return long.agg(*[(pick[n].cast("bigint") if n.startswith("n_") else pick[n]).alias(n) for n in order]).withColumn(
        "n_trees", F.lit(len(boosted_part(model).treeWeights) - 1).cast("bigint")).withColumn(
        "features", F.array(*[F.lit(c) for c in rules.FEATURE_COLS]))


def importances_frame(spark: SparkSession, values: list[float]) -> DataFrame:
    """M9: one row per model feature (23 rows)."""
    return spark.createDataFrame(list(zip(rules.FEATURE_COLS, [float(v) for v in values])),
                                 "feature string, importance double")


def sorted_importances(importances: DataFrame) -> DataFrame:
    """One partition, most important first: the order of the written artifact."""
    return importances.coalesce(1).sortWithinPartitions(F.desc("importance"), F.asc("feature"))


def top_importances(importances: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most important features."""
    return importances.orderBy(F.desc("importance"), F.asc("feature")).limit(n)


ML_CALL_LIST_COLS = [
    "call_rank", "clinician_id", "specialty", "state", "ehr_system", "practice_size", "org_type",
    "annual_patient_volume", "revenue_band", "logins_per_week", "days_since_last_login",
    "team_members_invited", "api_calls_per_week", "features_used_count", "engagement_tier",
    PROB, "baseline_propensity_score", "is_power_user", "sales_angle", "call_list_date",
]


def ml_call_list(model: PipelineModel, mart: DataFrame, k: int = rules.CALL_LIST_SIZE,
                 as_of: dt.date | None = None) -> DataFrame:
    """Eligible pool scored by the model, top-k by probability (ties by
    id), rank, talk track and the list date as text."""
    pool = models.eligible(mart)
    feats = prepare_features(pool, keep=tuple(pool.columns), label=None, prefix=MODEL_PREFIX)
    return _ml_list(score(model, feats), k, as_of)


def _ml_list(scored: DataFrame, k: int, as_of: dt.date | None, score_col: str = PROB) -> DataFrame:
    """Top-k of a scored pool in the model list's layout: positional rank,
    talk track in the model list's wording, list date as text."""
    ranked = top_k(scored, k, score_order(score_col), rank_col="call_rank")
    list_date = F.lit(as_of.isoformat()) if as_of else F.date_format(F.current_date(), "yyyy-MM-dd")
    cols = [c for c in ML_CALL_LIST_COLS if c not in ("sales_angle", "call_list_date")]
    if score_col != PROB:
        cols = [c for c in cols if c != PROB]
    return ranked.select(
        *cols,
        sales_angle(rules.ML_SALES_ANGLES).alias("sales_angle"),
        list_date.alias("call_list_date"),
    )


_models: dict[tuple, Trained] = {}
_lock = threading.Lock()


def trained(spark: SparkSession, mart: DataFrame, tag: str, params: dict | None = None) -> Trained:
    """Fit once per session and data tag; the artifact is saved in the
    shared folder and reloaded from there (S11)."""
    key = (session_key(spark), tag, repr(sorted((params or {}).items())))
    with _lock:
        return _trained(spark, mart, key, params)


def _trained(spark: SparkSession, mart: DataFrame, key: tuple, params: dict | None) -> Trained:
    if key not in _models:
        digest = hashlib.md5(repr(key).encode()).hexdigest()[:10]
        # the split is written once (bucketed by id): fit, calibration and
        # evaluation read the same exact assignment without recomputing it
        split = catalog.as_table(split_frame(mart), "marts", f"training_split_{digest}")
        model, imps = fit(split, params)
        path = table_path(spark, "artifacts", f"gbm_{digest}")
        model.write().overwrite().save(path)
        loaded = PipelineModel.load(path)
        _models[key] = Trained(loaded, path, evaluate(loaded, split), importances_frame(spark, imps), split)
    return _models[key]
