"""The three job steps end to end on the smallest tables."""

import datetime as dt
import uuid

import pytest

from propensa import jobs
from propensa.session import table_path
from propensa.sources import csv_io
from tests.conftest import SF_SMALL


def test_pipeline_train_score(spark):
    res = jobs.pipeline(spark, SF_SMALL)
    assert res["summary"].collect()[0].total_clinicians == 150
    assert [r.call_rank for r in res["top5"].collect()] == [1, 2, 3, 4, 5]
    names = {r.test_name for r in res["suite"].collect()}
    assert "assert_exactly_80_calls" in names and "assert_scores_in_range" in names
    out = table_path(spark, "tests", "jobs_" + uuid.uuid4().hex)
    tr = jobs.train(spark, SF_SMALL, out)
    assert spark.read.json(f"{out}/model_metrics").count() == 1
    assert csv_io.read_csv(spark, f"{out}/feature_importance").count() == 23
    assert tr.metrics.collect()[0].n_train + tr.metrics.collect()[0].n_test <= 150
    path = jobs.score(spark, SF_SMALL, out)
    assert path.endswith("weekly_call_list_2001-08-02")
    calls = csv_io.read_csv(spark, path).collect()
    assert len(calls) == 80 and sorted(r.call_rank for r in calls) == list(range(1, 81))


def test_cli_all(spark, capsys):
    out = table_path(spark, "tests", "cli_" + uuid.uuid4().hex)
    jobs.main(["all", "--sf-dir", SF_SMALL, "--out", out])
    printed = capsys.readouterr().out
    assert "weekly_call_list_2001-08-02" in printed
    assert "total_clinicians" in printed and "test_auc_roc" in printed


def test_score_needs_the_saved_model_and_the_mart(spark):
    from pyspark.ml import PipelineModel
    out = table_path(spark, "tests", "handover_" + uuid.uuid4().hex)
    jobs.pipeline(spark, SF_SMALL)
    with pytest.raises(Exception):
        jobs.score(spark, SF_SMALL, out)  # no model yet
    jobs.train(spark, SF_SMALL, out)
    assert len(PipelineModel.load(f"{out}/{jobs.MODEL_DIR}").stages) == 4
    top = csv_io.read_csv(spark, f"{out}/feature_importance").collect()
    assert [r.importance for r in top] == sorted((r.importance for r in top), reverse=True)
    assert csv_io.read_csv(spark, jobs.score(spark, SF_SMALL, out)).count() == 80
    with pytest.raises(Exception):
        jobs.score(spark, SF_SMALL, out, as_of=dt.date(1999, 1, 1))  # no mart of that date


def test_three_files_end_to_end(spark):
    """The steps from CSV files; two data sets in turn do not disturb each other."""
    from propensa.plans.queries import seed_files
    seeds = seed_files(spark, SF_SMALL)
    a = jobs.pipeline(spark, SF_SMALL)["summary"].collect()
    b = jobs.pipeline(spark, seeds, files=True)
    assert b["summary"].collect() == a
    key = dict(b["layers"]["mart_weekly_call_list"].dtypes)["clinician_id"]
    assert key == "string"
    assert jobs.pipeline(spark, SF_SMALL)["summary"].collect() == a


def test_failing_assertion_stops_the_run(spark, monkeypatch):
    monkeypatch.setattr(jobs, "ASSERTED", ("always",))
    monkeypatch.setattr(jobs, "run_all", lambda layers: spark.createDataFrame([("always", 1)], "test_name string, failures long"))
    with pytest.raises(jobs.CheckFailed, match="always"):
        jobs.pipeline(spark, SF_SMALL)
