"""Job entry points: the three steps a user of the pipeline runs.

    python -m propensa pipeline --seeds DIR   # load, run all layers, test suite, summary
    python -m propensa train    --seeds DIR --out SHARED   # fit, calibrate, evaluate, save the model
    python -m propensa score    --seeds DIR --out SHARED   # load the model, publish the dated call list

``--seeds`` names the folder with clinicians.csv, usage_metrics.csv and
firmographic_enrichment.csv; ``--sf-dir`` one with the parquet tables of the
input binding.  ``pipeline`` fails when an asserted check fails.  ``train`` and
``score`` read the mart that ``pipeline`` wrote and fail when it is missing;
``score`` fails when the model is missing or unreadable.  Layers go below
``spark.propensa.layers.dir`` (set it to a shared folder when the steps are
separate applications; default: the checkpoint folder); the model goes through
``<out>/gbm_model``.  Only bounded results (the summary row, the top-5
report, the failing-check counts, the metrics row) are shown on the driver.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from propensa import rules
from propensa.functions.scalar import round_half_up
from propensa.ml import train as T
from propensa.plans.pipeline import run, stored_mart
from propensa.plans.queries import mart_summary
from propensa.plans.validation import run_all
from propensa.session import table_path
from propensa.sources import csv_io
from propensa.sources.seeds import AS_OF


class CheckFailed(RuntimeError):
    """An asserted check of the test suite failed."""


#: Checks that stop the run; the others are reported.
ASSERTED = ("assert_exactly_80_calls", "assert_scores_in_range", "unique_mart_conversion_features_clinician_id")


def pipeline(spark: SparkSession, sf_dir: str, as_of: dt.date | None = AS_OF, files: bool = False) -> dict:
    layers = run(spark, sf_dir, as_of, files=files)
    suite = run_all(layers)
    failures = suite.filter(F.col("failures") > 0)
    broken = [f"{r.test_name}: {r.failures}" for r in failures.filter(F.col("test_name").isin(*ASSERTED)).collect()]
    if broken:
        raise CheckFailed("; ".join(sorted(broken)))
    summary = mart_summary(layers["mart_conversion_features"])
    top5 = (layers["mart_weekly_call_list"].orderBy("call_rank").limit(5)
            .select("call_rank", "clinician_id", "specialty", "practice_size", "engagement_tier",
                    round_half_up("baseline_propensity_score", 1).alias("score"), "sales_angle"))
    return {"layers": layers, "suite": suite, "failures": failures, "summary": summary, "top5": top5}


MODEL_DIR = "gbm_model"


def train(spark: SparkSession, sf_dir: str, out: str | None = None, as_of: dt.date | None = AS_OF, files: bool = False) -> T.Trained:
    """Fit, calibrate, evaluate; write the model, importances and metrics
    under ``out`` (a shared folder the scoring step can read)."""
    mart = stored_mart(spark, sf_dir, as_of, files)
    tr = T.trained(spark, mart, tag=f"{sf_dir.rstrip('/')}|{as_of}|{files}")
    base = out or table_path(spark, "artifacts")
    tr.model.write().overwrite().save(f"{base}/{MODEL_DIR}")
    csv_io.write_csv(T.sorted_importances(tr.importances), f"{base}/feature_importance")
    csv_io.write_json_record(tr.metrics, f"{base}/model_metrics")
    return tr


def score(spark: SparkSession, sf_dir: str, out: str | None = None, as_of: dt.date | None = AS_OF, files: bool = False) -> str:
    """Score the eligible pool of the stored mart with the saved model and publish the dated call list."""
    model = PipelineModel.load(f"{out or table_path(spark, 'artifacts')}/{MODEL_DIR}")
    calls = T.ml_call_list(model, stored_mart(spark, sf_dir, as_of, files), rules.CALL_LIST_SIZE, as_of)
    return csv_io.write_call_list(calls, out or table_path(spark, "outputs"), as_of or dt.date.today())


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="propensa")
    ap.add_argument("step", choices=["pipeline", "train", "score", "all"])
    where = ap.add_mutually_exclusive_group(required=True)
    where.add_argument("--seeds", help="folder with the three CSV files")
    where.add_argument("--sf-dir", help="folder with the parquet tables")
    ap.add_argument("--out", default=None)
    ap.add_argument("--as-of", default=AS_OF.isoformat(), help="snapshot date; 'today' for the wall clock")
    args = ap.parse_args(argv)
    as_of = None if args.as_of == "today" else dt.date.fromisoformat(args.as_of)

    spark = SparkSession.builder.appName("propensa").getOrCreate()
    files = args.seeds is not None
    source = args.seeds or args.sf_dir
    if args.step in ("pipeline", "all"):
        res = pipeline(spark, source, as_of, files)
        res["summary"].show(truncate=False)
        res["top5"].show(truncate=False)
        res["failures"].show(truncate=False)
    if args.step in ("train", "all"):
        train(spark, source, args.out, as_of, files).metrics.show(truncate=False)
    if args.step in ("score", "all"):
        print(score(spark, source, args.out, as_of, files))


if __name__ == "__main__":
    main()
