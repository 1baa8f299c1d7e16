"""CSV seeds (declared and inferred types, whitespace and 'None' kept, bad
dates to NULL) and a small end-to-end model run."""

import uuid

from pyspark.sql import functions as F

from propensa.operators.staging import stg_clinicians
from propensa.sources import csv_io
from propensa.session import table_path
from tests.conftest import SF_SMALL


def test_csv_round_trip_keeps_text(spark):
    rows = [(1, "2026-13-01", " Oncology ", " ca ", "None", "Solo", " x ", 5, 1, "2026-6-3"),
            (2, "2026-06-03", "Urology", "ny", "Epic", "Solo", "y", None, 0, None)]
    df = spark.createDataFrame(rows, ", ".join(f"{k} {'string' if v == 'varchar' else v}"
                                               for k, v in {**csv_io.CLINICIAN_TYPES, 'clinician_id': 'bigint'}.items()).replace("integer", "int"))
    path = table_path(spark, "tests", uuid.uuid4().hex, "clinicians")
    csv_io.write_csv(df, path)
    back = csv_io.read_csv(spark, path, csv_io.CLINICIAN_TYPES).orderBy("clinician_id").collect()
    assert back[0].specialty == " Oncology " and back[0].ehr_system == "None"
    stg = stg_clinicians(csv_io.read_csv(spark, path, csv_io.CLINICIAN_TYPES)).orderBy("clinician_id").collect()
    assert stg[0].signup_date is None and str(stg[0].conversion_date) == "2026-06-03"
    assert stg[0].specialty == "Oncology" and stg[0].state == "CA" and stg[0].converted_to_enterprise is True
    inferred = csv_io.read_csv(spark, path)
    assert dict(inferred.dtypes)["clinician_id"] in ("int", "bigint")


def test_model_fit_calibrate_save_load(spark):
    from pyspark.ml import PipelineModel

    from propensa.ml import train as T
    from propensa.plans.pipeline import graph

    mart = graph(spark, SF_SMALL)["mart_conversion_features"]
    model, imps = T.fit(mart, {"maxIter": 5, "minInstancesPerNode": 5})
    assert len(imps) == 23 and abs(sum(imps) - 1.0) < 1e-6 or sum(imps) == 0
    data = T.split_frame(mart)
    scored = model.transform(data)
    from pyspark.ml.functions import vector_to_array
    pairs = sorted((r[0], r[1]) for r in scored.select(
        F.element_at(vector_to_array("gbt_probability"), 2), T.PROB).collect())
    # isotonic calibration is monotone in the raw probability
    assert all(b1 <= b2 + 1e-12 for (_, b1), (_, b2) in zip(pairs, pairs[1:]))
    path = table_path(spark, "tests", uuid.uuid4().hex, "model")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path).transform(data).select("clinician_id", T.PROB).orderBy("clinician_id").collect()
    first = scored.select("clinician_id", T.PROB).orderBy("clinician_id").collect()
    assert again == first
    cl = T.ml_call_list(model, mart).collect()
    assert len(cl) == 80 and sorted(r.call_rank for r in cl) == list(range(1, 81))


def test_csv_quotes_keys_and_malformed_values(spark, tmp_path):
    import pytest
    types = {"clinician_id": "varchar", "note": "varchar", "n": "bigint"}
    (tmp_path / "a.csv").write_text('clinician_id,note,n\nCLN_00001,"Say ""hi"", ok",1\nCLN_00002,"two\nlines",2\n')
    rows = csv_io.read_csv(spark, str(tmp_path / "a.csv"), types, multiline=True).orderBy("clinician_id").collect()
    assert [tuple(r) for r in rows] == [("CLN_00001", 'Say "hi", ok', 1), ("CLN_00002", "two\nlines", 2)]
    back = csv_io.write_csv(csv_io.read_csv(spark, str(tmp_path / "a.csv"), types, multiline=True), str(tmp_path / "b.csv"))
    assert sorted(map(tuple, csv_io.read_csv(spark, back, types, multiline=True).collect())) == [tuple(r) for r in rows]
    (tmp_path / "c.csv").write_text("clinician_id,note,n\nCLN_00001,x,abc\n")
    with pytest.raises(Exception):
        csv_io.read_csv(spark, str(tmp_path / "c.csv"), types).collect()


def test_rows_without_a_label_are_left_out(spark):
    from propensa.ml.prepare import prepare_features
    df = spark.createDataFrame([(1, None, 1.0), (2, True, None), (3, False, 2.0)], "clinician_id int, converted_to_enterprise boolean, v double")
    got = prepare_features(df, feature_cols=["v"], bool_cols=[]).orderBy("clinician_id").collect()
    assert [tuple(r) for r in got] == [(2, 1, 0.0), (3, 0, 2.0)]


def test_calibration_of_weighted_points_equals_that_of_rows(spark):
    import random

    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import IsotonicRegression
    from propensa.ml.train import calibrate
    rnd = random.Random(5)
    rows = [(i, p, int(rnd.random() < p)) for i in range(400) for p in [rnd.randrange(30) / 30]]
    df = spark.createDataFrame(rows, "clinician_id int, p double, label int").select(
        "*", array_to_vector(F.array(1 - F.col("p"), F.col("p"))).alias("gbt_probability"))
    by_row = IsotonicRegression(featuresCol="p", labelCol="label", predictionCol="y").fit(df)
    want = {r.clinician_id: r.y for r in by_row.transform(df).collect()}
    got = {r.clinician_id: r.ml_conversion_probability for r in calibrate(df).transform(df).collect()}
    assert all(abs(got[i] - want[i]) < 1e-12 for i in want)
