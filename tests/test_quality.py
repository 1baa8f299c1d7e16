"""Quality checks both ways: clean input gives no rows; planted defects
give exactly the planted rows."""

from pyspark.sql import functions as F

from propensa import rules
from propensa.operators import quality as Q


def _planted(spark):
    rows = [
        (1, "Solo", "Champion", 50.0),
        (2, "Small (2-10)", "Active", 60.0),
        (2, "Small (2-10)", "Active", 60.0),       # duplicate
        (None, "Solo", "Casual", 10.0),            # NULL key
        (4, "Gigantic", "Dormant", 20.0),          # bad category
        (5, "Solo", "Power User", 129.0),          # out of range
        (6, "Solo", "Sleeper", None),              # bad tier, NULL score
    ]
    return spark.createDataFrame(rows, "clinician_id int, practice_size string, engagement_tier string, score double")


def test_unique_finds_planted_duplicate(spark):
    got = Q.unique(_planted(spark), "clinician_id").collect()
    assert [(r.clinician_id, r.row_count) for r in got] == [(2, 2)]


def test_not_null(spark):
    got = Q.not_null(_planted(spark), "clinician_id").collect()
    assert len(got) == 1
    got = Q.not_null(_planted(spark), "score").collect()
    assert [r.clinician_id for r in got] == [6]


def test_accepted_values(spark):
    got = Q.accepted_values(_planted(spark), "practice_size", rules.PRACTICE_SIZES).collect()
    assert [(r.value, r.n_records) for r in got] == [("Gigantic", 1)]


def test_range_and_expression(spark):
    df = _planted(spark)
    assert [r.clinician_id for r in Q.in_range(df, "score", 0, 128).collect()] == [5]
    assert [r.clinician_id for r in Q.expression_is_true(df, "score <= 128").collect()] == [5]


def test_relationships_orphans(spark):
    parent = spark.createDataFrame([(1,), (2,)], "clinician_id int")
    child = spark.createDataFrame([(1,), (3,), (None,)], "clinician_id int")
    assert [r.clinician_id for r in Q.relationships(child, parent).collect()] == [3]


def test_aggregate_is(spark):
    df = spark.range(80)
    assert Q.aggregate_is(df, F.count(F.lit(1)), 80).count() == 0
    assert Q.aggregate_is(spark.range(79), F.count(F.lit(1)), 80).collect()[0][0] == 79


def test_suite_counts_planted_and_clean(spark):
    df = _planted(spark)
    t = Q.TableChecks("t", df, {
        "nn_key": Q.not_null_failure("clinician_id"),
        "acc_size": Q.accepted_failure("practice_size", rules.PRACTICE_SIZES),
        "range": Q.range_failure("score", 0, 128),
    }, unique_keys=["clinician_id"])
    got = {r.test_name: r.failures for r in Q.run_suite([t]).collect()}
    assert got == {"nn_key": 1, "acc_size": 1, "range": 1, "unique_t_clinician_id": 1}
    clean = Q.TableChecks("c", spark.range(5).withColumnRenamed("id", "clinician_id"),
                          {"nn": Q.not_null_failure("clinician_id")}, unique_keys=["clinician_id"])
    assert all(r.failures == 0 for r in Q.run_suite([clean]).collect())
