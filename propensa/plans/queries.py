"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the driver tables.

Outputs keep the engine-neutral types the SQL oracle uses: exact DECIMAL
columns are returned as DOUBLE; timestamps are ``timestamp_ntz``.
"""

from __future__ import annotations

import hashlib
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propensa import rules
from propensa.functions import scoring
from propensa.functions.scalar import round_half_up
from propensa.ml.prepare import prepare_features
from propensa.ml.split import assign_split
from propensa.operators import metrics as M
from propensa.operators import quality as Q
from propensa.operators.isotonic import isotonic_blocks, isotonic_model
from propensa.operators.lookup import with_lookup
from propensa.operators.rank import sorted_by_score, with_position
from propensa.operators.staging import stg_usage_metrics
from propensa.plans import models
from propensa.plans.pipeline import graph
from propensa.plans.validation import run_all
from propensa.session import session_key, table_path
from propensa.sources import csv_io
from propensa.sources.seed_files import seed_file
from propensa.sources.seeds import AS_OF, raw_inputs
from propensa.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def neutral(df: DataFrame) -> DataFrame:
    """DECIMAL -> DOUBLE at the edge (engines type decimal results differently)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def G(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return graph(spark, sf_dir, AS_OF)


_csv_written: dict[tuple, str] = {}


def seed_csv(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Export a raw seed to CSV once per session (seeds arrive as CSV
    files in the original flow); returns the folder."""
    tag = hashlib.md5(f"{sf_dir.rstrip('/')}|{name}".encode()).hexdigest()[:10]
    key = (session_key(spark), tag)
    if key not in _csv_written:
        path = table_path(spark, "seeds_csv", f"{name}_{tag}")
        csv_io.write_csv(raw_inputs(spark, sf_dir, AS_OF)[name], path)
        _csv_written[key] = path
    return _csv_written[key]


# --- sources ----------------------------------------------------------------

@register("s1_csv_scan_inferred_usage")
def s1(spark, sf_dir):
    """Usage seed from CSV with inferred types (the key declared), then the
    staging casts."""
    return stg_usage_metrics(csv_io.read_csv(spark, seed_csv(spark, sf_dir, "usage_metrics"),
                                             declared={"clinician_id": "bigint"}))


@register("s2_csv_scan_declared_clinicians")
def s2(spark, sf_dir):
    """Clinicians seed from CSV with declared column types."""
    return csv_io.read_csv(spark, seed_csv(spark, sf_dir, "clinicians"), {**csv_io.CLINICIAN_TYPES, "clinician_id": "bigint"})


def seed_files(spark, sf_dir) -> str:
    """The three raw inputs as the CSV files a user would bring; returns their folder."""
    key = (session_key(spark), "files", sf_dir.rstrip("/"))
    if key not in _csv_written:
        base = table_path(spark, "seed_files", hashlib.md5(sf_dir.rstrip("/").encode()).hexdigest()[:10])
        for name, df in raw_inputs(spark, sf_dir, AS_OF).items():
            csv_io.write_csv(df, seed_file(base, name))
        _csv_written[key] = base
    return _csv_written[key]


@register("s2_mart_from_csv_files")
def s2_mart(spark, sf_dir):
    """The mart, from the three CSV files with text keys."""
    return neutral(graph(spark, seed_files(spark, sf_dir), AS_OF, files=True)["mart_conversion_features"])


@register("s2_call_list_from_csv_files")
def s2_calls(spark, sf_dir):
    """The call list, from the three CSV files with text keys."""
    return neutral(graph(spark, seed_files(spark, sf_dir), AS_OF, files=True)["mart_weekly_call_list"])


@register("s6_seed_firmographics")
def s6(spark, sf_dir):
    return G(spark, sf_dir)["raw_firmographic_enrichment"]


# --- staging projections -----------------------------------------------------

@register("p1_stg_clinicians")
def p1(spark, sf_dir):
    return G(spark, sf_dir)["stg_clinicians"]


@register("p2_stg_usage_metrics")
def p2(spark, sf_dir):
    return G(spark, sf_dir)["stg_usage_metrics"]


@register("p3_stg_firmographic_enrichment")
def p3(spark, sf_dir):
    return G(spark, sf_dir)["stg_firmographic_enrichment"]


@register("p5_model_feature_projection")
def p5(spark, sf_dir):
    return prepare_features(G(spark, sf_dir)["mart_conversion_features"])


@register("p6_eligible_pool")
def p6(spark, sf_dir):
    return neutral(models.eligible(G(spark, sf_dir)["mart_conversion_features"]).select(
        "clinician_id", "days_since_last_login", "days_on_platform", "baseline_propensity_score"))


# --- domain scoring ------------------------------------------------------------

def _eng(spark, sf_dir, *cols):
    return G(spark, sf_dir)["int_clinician_engagement"].select("clinician_id", *cols)


@register("d1_recency_score")
def d1(spark, sf_dir):
    return _eng(spark, sf_dir, "days_since_last_login", "recency_score")


@register("d2_frequency_score")
def d2(spark, sf_dir):
    return _eng(spark, sf_dir, "logins_per_week", "frequency_score")


@register("d3_expansion_score")
def d3(spark, sf_dir):
    return _eng(spark, sf_dir, "team_members_invited", "api_calls_per_week", "features_used_count", "expansion_score")


@register("d4_engagement_tier")
def d4(spark, sf_dir):
    return _eng(spark, sf_dir, "logins_per_week", "team_members_invited", "api_calls_per_week", "engagement_tier")


def _firmo(spark, sf_dir, *cols):
    return neutral(G(spark, sf_dir)["int_clinician_firmographic_score"].select("clinician_id", *cols))


@register("d5_practice_size_score")
def d5(spark, sf_dir):
    return _firmo(spark, sf_dir, "practice_size", "practice_size_score")


@register("d6_ehr_maturity_score")
def d6(spark, sf_dir):
    return _firmo(spark, sf_dir, "ehr_system", "ehr_maturity_score")


@register("d7_specialty_need_score")
def d7(spark, sf_dir):
    return _firmo(spark, sf_dir, "specialty", "specialty_need_score")


@register("d5_lookup_by_rule_table")
def d5_table(spark, sf_dir):
    """Open orders of every clinician, looked up in a table as large as the data."""
    table = (read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderstatus"]).filter("o_orderstatus = 'O'")
             .groupBy(F.col("o_custkey").alias("name")).agg(F.count(F.lit(1)).alias("value")))
    return with_lookup(G(spark, sf_dir)["stg_clinicians"].select("clinician_id"), "clinician_id", "open_orders", table, 0)


# ``ln`` may differ by one ulp between engines (StrictMath vs libm), so
# the raw volume score is compared at 10 decimals; the composite score is
# computed from the unrounded value.
def _volume_10(df):
    return df.withColumn("patient_volume_score", round_half_up("patient_volume_score", 10))


@register("d8_patient_volume_score")
def d8(spark, sf_dir):
    return _volume_10(_firmo(spark, sf_dir, "annual_patient_volume", "patient_volume_score"))


@register("d9_firmographic_score")
def d9(spark, sf_dir):
    return _firmo(spark, sf_dir, "firmographic_score")


def _feat(spark, sf_dir, *cols):
    return neutral(G(spark, sf_dir)["int_clinician_features"].select("clinician_id", *cols))


@register("d10_behavioral_score")
def d10(spark, sf_dir):
    return _feat(spark, sf_dir, "behavioral_score")


@register("d11_power_user_flag")
def d11(spark, sf_dir):
    return _feat(spark, sf_dir, "team_members_invited", "api_calls_per_week", "is_power_user")


@register("d12_at_risk_flag")
def d12(spark, sf_dir):
    return _feat(spark, sf_dir, "days_since_last_login", "is_at_risk")


@register("d13_baseline_propensity_score")
def d13(spark, sf_dir):
    return neutral(G(spark, sf_dir)["mart_conversion_features"].select("clinician_id", "baseline_propensity_score"))


@register("d14_sales_angle")
def d14(spark, sf_dir):
    from propensa.functions.scoring import sales_angle
    pool = models.eligible(G(spark, sf_dir)["mart_conversion_features"])
    return pool.select("clinician_id", sales_angle().alias("sales_angle"))


@register("d15_int_clinician_engagement")
def d15(spark, sf_dir):
    return G(spark, sf_dir)["int_clinician_engagement"]


@register("d16_int_clinician_firmographic_score")
def d16(spark, sf_dir):
    return _volume_10(neutral(G(spark, sf_dir)["int_clinician_firmographic_score"]))


@register("d17_int_clinician_features")
def d17(spark, sf_dir):
    return neutral(G(spark, sf_dir)["int_clinician_features"])


@register("d18_mart_conversion_features")
def d18(spark, sf_dir):
    return neutral(G(spark, sf_dir)["mart_conversion_features"])


@register("d19_weekly_call_list")
def d19(spark, sf_dir):
    return neutral(G(spark, sf_dir)["mart_weekly_call_list"])


# --- joins -----------------------------------------------------------------------

@register("j1_clinician_firmographic_left_join")
def j1(spark, sf_dir):
    return G(spark, sf_dir)["int_clinician_firmographic_score"].select(
        "clinician_id", "practice_size", "annual_patient_volume", "revenue_band", "num_locations",
        "has_billing_system", "accepts_insurance", "is_group_practice")


@register("j2_features_engagement_left_join")
def j2(spark, sf_dir):
    return neutral(G(spark, sf_dir)["int_clinician_features"].select(
        "clinician_id", "firmographic_score", "logins_per_week", "engagement_tier", "recency_score"))


@register("j3_orphan_keys")
def j3(spark, sf_dir):
    g = G(spark, sf_dir)
    clin = g["stg_clinicians"]
    return (Q.relationships(g["stg_usage_metrics"], clin).withColumn("child", F.lit("stg_usage_metrics"))
            .unionByName(Q.relationships(g["stg_firmographic_enrichment"], clin)
                         .withColumn("child", F.lit("stg_firmographic_enrichment"))))


# --- aggregates --------------------------------------------------------------------

@register("a1_row_counts")
def a1(spark, sf_dir):
    g = G(spark, sf_dir)
    mart = g["mart_conversion_features"]
    parts = {
        "raw_clinicians": g["raw_clinicians"],
        "raw_usage_metrics": g["raw_usage_metrics"],
        "raw_firmographic_enrichment": g["raw_firmographic_enrichment"],
        "mart_conversion_features": mart,
        "eligible_pool": models.eligible(mart),
        "mart_weekly_call_list": g["mart_weekly_call_list"],
    }
    out = None
    for name, df in parts.items():
        c = df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = c if out is None else out.unionByName(c)
    return out


@register("a8_mart_summary")
def a8(spark, sf_dir):
    return mart_summary(G(spark, sf_dir)["mart_conversion_features"])


def mart_summary(mart: DataFrame) -> DataFrame:
    """Count, converted count and rate, mean score, power-user share; the
    score total is an exact decimal sum, so the mean does not depend on
    the partitioning."""
    n = F.count(F.lit(1))
    return mart.agg(
        n.cast("bigint").alias("total_clinicians"),
        F.sum(F.col("converted_to_enterprise").cast("int")).cast("bigint").alias("converted"),
        (F.sum(F.col("baseline_propensity_score").cast("decimal(18,2)")).cast("double")
         / F.count("baseline_propensity_score").cast("double")).alias("avg_score"),
        (F.sum(F.when(F.col("is_power_user"), 1).otherwise(0)).cast("double") / n.cast("double")).alias("pct_power_users"),
        (F.sum(F.col("converted_to_enterprise").cast("int")).cast("double") / n.cast("double")).alias("conversion_rate"),
    )


@register("a6_out_of_range_count")
def a6(spark, sf_dir):
    lo, hi = rules.SCORE_RANGE
    mart = G(spark, sf_dir)["mart_conversion_features"]
    return mart.agg(F.count_if(Q.range_failure("baseline_propensity_score", lo, hi)).cast("bigint").alias("violations"))


# --- ordering and top-k ------------------------------------------------------------

@register("o1_mart_sorted_by_score")
def o1(spark, sf_dir):
    """The sorted mart, each row with the place it has in the output."""
    mart = G(spark, sf_dir)["mart_conversion_features"].select("clinician_id", "baseline_propensity_score", "engagement_tier")
    return neutral(with_position(sorted_by_score(mart, "baseline_propensity_score"), "place"))


@register("o5_top5_report")
def o5(spark, sf_dir):
    cl = G(spark, sf_dir)["mart_weekly_call_list"]
    return (cl.orderBy("call_rank").limit(5)
            .select("call_rank", "clinician_id", "specialty", "practice_size", "engagement_tier",
                    round_half_up("baseline_propensity_score", 1).alias("score"), "sales_angle"))


# --- data quality -------------------------------------------------------------------

@register("q1_unique_stg_clinicians")
def q1(spark, sf_dir):
    return Q.unique(G(spark, sf_dir)["stg_clinicians"], "clinician_id")


@register("q2_not_null_baseline_score")
def q2(spark, sf_dir):
    return neutral(Q.not_null(G(spark, sf_dir)["mart_conversion_features"], "baseline_propensity_score"))


@register("q3_accepted_values_engagement_tier")
def q3(spark, sf_dir):
    return Q.accepted_values(G(spark, sf_dir)["mart_conversion_features"], "engagement_tier", rules.ENGAGEMENT_TIERS)


@register("q4_relationships_usage_to_clinicians")
def q4(spark, sf_dir):
    g = G(spark, sf_dir)
    return Q.relationships(g["stg_usage_metrics"], g["stg_clinicians"])


@register("q5_expression_logins_non_negative")
def q5(spark, sf_dir):
    return Q.expression_is_true(G(spark, sf_dir)["stg_usage_metrics"], "logins_per_week >= 0").select(
        "clinician_id", "logins_per_week")


@register("q6_call_list_has_80_rows")
def q6(spark, sf_dir):
    return Q.aggregate_is(G(spark, sf_dir)["mart_weekly_call_list"], F.count(F.lit(1)), rules.CALL_LIST_SIZE,
                          name="row_count")


@register("q7_scores_in_range")
def q7(spark, sf_dir):
    lo, hi = rules.SCORE_RANGE
    return neutral(Q.in_range(G(spark, sf_dir)["mart_conversion_features"], "baseline_propensity_score", lo, hi))


@register("q8_no_duplicate_clinicians")
def q8(spark, sf_dir):
    return Q.unique(G(spark, sf_dir)["mart_conversion_features"], "clinician_id")


def materialized(spark, sf_dir):
    """The layers written as tables (once per session and data set)."""
    from propensa.plans.pipeline import run
    return run(spark, sf_dir, AS_OF)


@register("q9_test_suite")
def q9(spark, sf_dir):
    """All checks over the materialised layers (tests run after the run)."""
    return run_all(materialized(spark, sf_dir))


# --- ML preparation and metrics on the baseline score ---------------------------------

@register("m2_stratified_split")
def m2(spark, sf_dir):
    prepared = prepare_features(G(spark, sf_dir)["mart_conversion_features"], feature_cols=[], bool_cols=[])
    return assign_split(prepared).select("clinician_id", "label", "split")


def _scored(spark, sf_dir):
    return G(spark, sf_dir)["mart_conversion_features"].select(
        "clinician_id", "baseline_propensity_score", F.col("converted_to_enterprise").cast("int").alias("label"))


@register("m6_roc_auc_baseline")
def m6(spark, sf_dir):
    return M.roc_auc(_scored(spark, sf_dir), "baseline_propensity_score", "label")


@register("m7_average_precision_baseline")
def m7(spark, sf_dir):
    return M.average_precision(_scored(spark, sf_dir), "baseline_propensity_score", "label")


@register("m8_precision_at_80_baseline")
def m8(spark, sf_dir):
    return M.precision_at_k(_scored(spark, sf_dir), "baseline_propensity_score", "label", rules.TOP_K_METRIC)


@register("m4_isotonic_baseline")
def m4_baseline(spark, sf_dir):
    """Isotonic regression of the label on whole points of the baseline score."""
    scored = _scored(spark, sf_dir).withColumn("score", F.floor("baseline_propensity_score").cast("double"))
    points = M.score_counts(scored, "score", "label")
    curve = isotonic_model(isotonic_blocks(points), "score", "value")
    return curve.transform(points).select("score", "pos", "cnt", (F.floor(F.col("value") * 1e9 + F.lit(0.5)) / 1e9).alias("calibrated"))


# --- materialisations and sinks --------------------------------------------------------

CALL_LIST_TYPES = {
    "call_rank": "integer", "clinician_id": "bigint", "specialty": "varchar", "state": "varchar",
    "ehr_system": "varchar", "practice_size": "varchar", "org_type": "varchar",
    "annual_patient_volume": "bigint", "revenue_band": "varchar", "logins_per_week": "bigint",
    "days_since_last_login": "bigint", "team_members_invited": "bigint", "api_calls_per_week": "bigint",
    "features_used_count": "bigint", "is_power_user": "boolean", "engagement_tier": "varchar",
    "baseline_propensity_score": "double", "sales_angle": "varchar", "call_list_date": "date",
}


@register("s5_materialized_layers_call_list")
def s5(spark, sf_dir):
    """Full materialised run (layer namespaces, staging views, bucketed
    intermediate and mart tables); returns the call-list table read back."""
    return neutral(materialized(spark, sf_dir)["mart_weekly_call_list"])


@register("s8_call_list_csv_sink")
def s8(spark, sf_dir):
    """Dated CSV sink of the call list, read back with declared types."""
    base = table_path(spark, "outputs", hashlib.md5(sf_dir.encode()).hexdigest()[:10])
    path = csv_io.write_call_list(neutral(G(spark, sf_dir)["mart_weekly_call_list"]), base, AS_OF)
    return csv_io.read_csv(spark, path, CALL_LIST_TYPES)


# --- compositions: split + metrics, more checks ------------------------------------------

def _scored_test(spark, sf_dir):
    """Baseline score on the test part of the stratified split."""
    kept = prepare_features(G(spark, sf_dir)["mart_conversion_features"], feature_cols=[], bool_cols=[],
                            keep=("clinician_id", "baseline_propensity_score"))
    return assign_split(kept).filter(F.col("split") == "test")


@register("m6_roc_auc_baseline_test_split")
def m6t(spark, sf_dir):
    return M.roc_auc(_scored_test(spark, sf_dir), "baseline_propensity_score", "label")


@register("m7_average_precision_baseline_test_split")
def m7t(spark, sf_dir):
    return M.average_precision(_scored_test(spark, sf_dir), "baseline_propensity_score", "label")


@register("m8_precision_at_80_baseline_test_split")
def m8t(spark, sf_dir):
    return M.precision_at_k(_scored_test(spark, sf_dir), "baseline_propensity_score", "label", rules.TOP_K_METRIC)


@register("q3_accepted_values_practice_size")
def q3b(spark, sf_dir):
    return Q.accepted_values(G(spark, sf_dir)["stg_clinicians"], "practice_size", rules.PRACTICE_SIZES)


@register("q2_not_null_signup_date")
def q2b(spark, sf_dir):
    return Q.not_null(G(spark, sf_dir)["stg_clinicians"], "signup_date")


@register("q4_relationships_firmographics_to_clinicians")
def q4b(spark, sf_dir):
    g = G(spark, sf_dir)
    return Q.relationships(g["stg_firmographic_enrichment"], g["stg_clinicians"])


@register("w2_ranked_list_layout_on_baseline")
def w2(spark, sf_dir):
    """The model list's ranking and layout (positional rank, its talk-track
    wording, text date) fed with a fixed score, the baseline, so the
    non-model part of M11 is checked exactly."""
    from propensa.ml.train import _ml_list
    pool = models.eligible(G(spark, sf_dir)["mart_conversion_features"])
    return neutral(_ml_list(pool, rules.CALL_LIST_SIZE, AS_OF, score_col="baseline_propensity_score"))


# --- the same checks over driver columns where violations exist ----------------------------

@register("q1_unique_order_customers")
def q1v(spark, sf_dir):
    return Q.unique(read_table(spark, sf_dir, "orders", ["o_custkey"]), "o_custkey")


@register("q3_accepted_values_order_priority")
def q3v(spark, sf_dir):
    return Q.accepted_values(read_table(spark, sf_dir, "orders", ["o_orderpriority"]), "o_orderpriority", ["1-URGENT", "2-HIGH"])


@register("q4_relationships_customers_to_orders")
def q4v(spark, sf_dir):
    """Customers without an order over 400,000."""
    big = read_table(spark, sf_dir, "orders", ["o_custkey", "o_totalprice"]).filter("o_totalprice > 400000")
    return Q.relationships(read_table(spark, sf_dir, "customer", ["c_custkey"]), big, "c_custkey", "o_custkey")


@register("q5_expression_account_balance")
def q5v(spark, sf_dir):
    return Q.expression_is_true(read_table(spark, sf_dir, "customer", ["c_custkey", "c_acctbal"]), "c_acctbal >= 0")


@register("q6_aggregate_order_count")
def q6v(spark, sf_dir):
    return Q.aggregate_is(read_table(spark, sf_dir, "orders", ["o_orderkey"]), F.count(F.lit(1)), 0, name="row_count")


@register("q7_balance_in_range")
def q7v(spark, sf_dir):
    return Q.in_range(read_table(spark, sf_dir, "customer", ["c_custkey", "c_acctbal"]), "c_acctbal", 0, 9000, key="c_custkey")


@register("d6_ehr_maturity_all_values")
def d6v(spark, sf_dir):
    """Every value of the EHR map, and one that it lacks, spread over the customers."""
    names = F.array(*[F.lit(n) for n in [*rules.EHR_MATURITY_SCORES, "Unlisted"]])
    c = read_table(spark, sf_dir, "customer", ["c_custkey"])
    c = c.withColumn("ehr_system", names[(F.col("c_custkey") % F.size(names)).cast("int")])
    return c.select("c_custkey", "ehr_system", scoring.lookup_score("ehr_system", rules.EHR_MATURITY_SCORES, rules.EHR_MATURITY_DEFAULT).alias("ehr_maturity_score"))


@register("d7_specialty_need_all_values")
def d7v(spark, sf_dir):
    """Every value of the specialty map, and one that it lacks, spread over the customers."""
    names = F.array(*[F.lit(n) for n in [*rules.SPECIALTY_NEED_SCORES, "Unlisted"]])
    c = read_table(spark, sf_dir, "customer", ["c_custkey"])
    c = c.withColumn("specialty", names[(F.col("c_custkey") % F.size(names)).cast("int")])
    return c.select("c_custkey", "specialty", scoring.lookup_score("specialty", rules.SPECIALTY_NEED_SCORES, rules.SPECIALTY_NEED_DEFAULT).alias("specialty_need_score"))
