"""Boosting: patience window, cut ensembles, sampling by hash, independence of partitions."""

import math
import random
import uuid

import pytest
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from propensa.ml import boosting as B
from propensa.session import table_path

PARAMS = {"maxIter": 6, "stepSize": 0.3, "maxDepth": 3, "minInstancesPerNode": 5, "subsamplingRate": 0.8, "featureSubsetStrategy": "sqrt", "seed": 42}


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(4)
    data = []
    for i in range(900):
        x = [rnd.random(), rnd.randrange(3), float(rnd.randrange(200)), rnd.random()]
        data.append((i, *x, int(rnd.random() < 1 / (1 + math.exp(3 - 4 * x[0] - x[1]))), "validation" if i % 10 == 0 else "train"))
    df = spark.createDataFrame(data, "clinician_id int, a double, b int, c double, d double, label int, split string")
    names = ["a", "b", "c", "d"]
    df = df.withColumn("b", F.col("b").cast("double"))
    buckets = B.bucketizer(df.where("split = 'train'"), names, [f"b_{c}" for c in names], 32, "clinician_id", 810)
    return VectorAssembler(inputCols=[f"b_{c}" for c in names], outputCol="buckets").transform(buckets.transform(df)).cache()


def described(model):
    return [t.toDebugString.split("\n", 1)[1] for t in model.trees]


def probabilities(model, rows):
    return {r[0]: r[1] for r in model.transform(rows).select("clinician_id", vector_to_array(model.getProbabilityCol())[1]).collect()}


def test_patience_window_on_a_loss_curve():
    falling = [1 - 0.01 * i for i in range(60)]
    assert not any(B.stops(falling[:i], 25, 1e-4) for i in range(1, 61))
    flat = falling[:10] + [falling[9]] * 50
    # round 35 (from 1) is the first with only flat rounds in the 25 before it
    assert [i for i in range(1, 61) if B.stops(flat[:i], 25, 1e-4)][0] == 35
    assert B.stops([0.5, 0.4, 0.3, 0.6], 2, 1e-4) and not B.stops([0.5, 0.4, 0.3], 3, 1e-4)


def test_trees_do_not_depend_on_partitions(rows):
    models = [B.boost(rows.repartition(n, *by), PARAMS, 25, 1e-4) for n, by in ((3, []), (8, ["label"]), (64, []))]
    assert described(models[0][0]) == described(models[1][0]) == described(models[2][0])
    assert models[0][1] == models[1][1] == models[2][1] and len(models[0][1]) == 6


def test_a_cut_ensemble_is_the_shorter_fit(spark, rows):
    long, losses = B.boost(rows, PARAMS, 25, 1e-4)
    short, first = B.boost(rows, {**PARAMS, "maxIter": 3}, 25, 1e-4)
    cut = B.first_rounds(long, 3)
    assert losses[:3] == first and described(cut) == described(short) and cut.treeWeights == [1.0, 0.3, 0.3, 0.3]
    path = table_path(spark, "tests", uuid.uuid4().hex, "gbt")
    cut.save(path)
    assert probabilities(GBTClassificationModel.load(path), rows) == probabilities(short, rows)


def test_patience_ends_the_fit(rows):
    model, losses = B.boost(rows, {**PARAMS, "maxIter": 30}, 2, 10.0)  # nothing falls by 10
    assert len(losses) == 3 and len(model.trees) == 4
    everything, none = B.boost(rows, {**PARAMS, "maxIter": 4}, None, 1e-4)
    assert none == [] and len(everything.trees) == 5


def test_losses_and_probabilities_follow_from_the_trees(rows):
    model, losses = B.boost(rows, PARAMS, 25, 1e-4)
    p = probabilities(model, rows)
    held = [(r.clinician_id, r.label) for r in rows.where("split = 'validation'").collect()]
    loss = sum(-2 * math.log(p[i] if y else 1 - p[i]) for i, y in held) / len(held)
    assert abs(loss - losses[-1]) < 1e-6 and losses[-1] < losses[0]


def test_sampling_takes_the_rate_and_other_rows_each_round(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "clinician_id")
    got = ids.select(B.sampled("clinician_id", 42, 1, 0.8).alias("a"), B.sampled("clinician_id", 42, 2, 0.8).alias("b"))
    r = got.agg(F.avg(F.col("a").cast("int")).alias("a"), F.avg((F.col("a") & F.col("b")).cast("int")).alias("both")).first()
    assert abs(r.a - 0.8) < 0.02 and abs(r.both - 0.64) < 0.02


def test_one_class_and_no_validation_rows(rows):
    model, losses = B.boost(rows.where("label = 1 and split = 'train'"), {**PARAMS, "maxIter": 2}, 25, 1e-4)
    assert losses == [] and min(probabilities(model, rows).values()) > 0.999
    with pytest.raises(ValueError):
        B.boost(rows.limit(0), PARAMS, 25, 1e-4)


def test_model_does_not_depend_on_table_layout(spark):
    from propensa.ml import train as T
    from propensa.plans.pipeline import graph
    from tests.conftest import SF_SMALL

    split = T.split_frame(graph(spark, SF_SMALL)["mart_conversion_features"]).cache()
    params = {"maxIter": 5, "minInstancesPerNode": 5}
    a = T.fit(split.repartition(7), params)
    b = T.fit(split.repartition(2, "label"), params)
    assert a[1] == b[1] and described(T.boosted_part(a[0])) == described(T.boosted_part(b[0]))
