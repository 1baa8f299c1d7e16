"""Trees grown from counts: the same as Spark ML's, by few jobs a round."""

import math
import uuid

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from propensa.ml import boosting as B
from propensa.ml import trees as T

PARAMS = {"maxIter": 12, "stepSize": 0.3, "maxDepth": 4, "minInstancesPerNode": 4, "subsamplingRate": 0.8, "featureSubsetStrategy": "sqrt", "seed": 7}


@pytest.fixture(scope="module")
def rows(spark):
    """Seven features of bucket numbers: one has gaps, one a single value, one is never 0."""
    x = [F.pmod(F.xxhash64("clinician_id", F.lit(i)), F.lit(k)).cast("double") for i, k in enumerate((2, 5, 30, 9))]
    x += [F.lit(3.0), x[2] - F.pmod(x[2], F.lit(7.0)), x[3] + 2]
    y = (F.pmod(F.xxhash64("clinician_id", F.lit("y")), F.lit(40)) < x[2] + 3 * x[0]).cast("int")
    df = spark.range(700).select(F.col("id").alias("clinician_id"), array_to_vector(F.array(*x)).alias("buckets"), y.alias("label"),
                                 F.when(F.col("id") % 8 == 0, "validation").otherwise("train").alias("split"))
    return df.cache()


def described(tree):
    return tree.toDebugString.split("\n", 1)[1]


def test_trees_are_those_of_spark_ml(rows):
    model, _ = B.boost(rows, PARAMS, 25, 1e-4)
    train = rows.where("split = 'train'")
    state = train.select("clinician_id", "buckets", (2.0 * F.col("label") - 1).alias("y"), F.lit(model.trees[0].predict(rows.first().buckets)).alias("margin"))
    assert len(model.trees) == 13
    for turn in range(1, 4):
        y = F.col("y")
        gradient = F.floor(4 * y / (1 + F.exp(2 * y * F.col("margin"))) * B.GRID + 0.5) / B.GRID
        part = state.where(B.sampled("clinician_id", 7, turn, 0.8)).withColumn("residual", gradient)
        learner = RandomForestRegressor(featuresCol="buckets", labelCol="residual", predictionCol="step", numTrees=1, bootstrap=False, subsamplingRate=1.0,
                                        featureSubsetStrategy="sqrt", maxDepth=4, minInstancesPerNode=4, maxBins=64, seed=7 + turn)
        tree = learner.fit(part).trees[0]
        assert described(model.trees[turn]) == described(tree)
        assert model.trees[turn].featureImportances == tree.featureImportances
        state = tree.setFeaturesCol("buckets").setPredictionCol("step").transform(state).withColumn("margin", F.col("margin") + 0.3 * F.col("step")).drop("step")


def test_a_round_is_one_job_a_level(spark, rows):
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, "boosting")
    try:
        B.boost(rows, {**PARAMS, "maxIter": 9}, 25, 1e-4)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    # nine rounds of four levels, and what is done once
    assert len(sc.statusTracker().getJobIdsForGroup(group)) <= 9 * 4 + 16


def test_all_features_and_no_levels(rows):
    model, _ = B.boost(rows, {**PARAMS, "maxIter": 2, "featureSubsetStrategy": "all"}, 25, 1e-4)
    assert max(t.depth for t in model.trees) == 4
    flat, losses = B.boost(rows, {**PARAMS, "maxIter": 2, "maxDepth": 0}, 25, 1e-4)
    assert [t.numNodes for t in flat.trees] == [1, 1, 1] and len(losses) == 2
    shown = rows.select(vector_to_array(F.col("buckets"))[0].alias("x")).agg(F.count("x")).first()[0]
    assert flat.setFeaturesCol("buckets").transform(rows).count() == shown == 700


def test_blocks_add_up():
    buckets = np.array([[0, 1, 1, 4, 4, 0], [2, 2, 2, 2, 2, 2]], np.uint8)
    r, at, taken = np.array([8.0, -4, 2, 6, 1, 5]), np.zeros(6, np.uint8), np.array([1, 1, 1, 1, 0, 1], bool)
    whole = T.count(buckets, r, at, taken, [(0, [1, 0])], 5)
    halves = T.added([T.count(buckets[:, s], r[s], at[s], taken[s], [(0, [1, 0])], 5) for s in (slice(0, 2), slice(2, 6))])
    assert whole[0].tolist() == halves[0].tolist()
    assert whole[0][1].tolist() == [[2, 2, 0, 0, 1], [13, -2, 0, 0, 6], [89, 20, 0, 0, 36]]
    assert [T.subset_size(s, 23) for s in ("sqrt", "all", "log2", "onethird", "7", "0.5")] == [5, 23, 5, 8, 7, 12] and math.isclose(float(T.variance(np.float64(2), np.float64(4), np.float64(10))), 1.0)
