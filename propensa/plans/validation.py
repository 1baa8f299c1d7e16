"""The pipeline's test suite: the schema tests of every layer plus the two
singular tests, run as one ``quality.run_suite``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensa import rules
from propensa.operators import quality as Q


def suite_spec(g: dict[str, DataFrame], call_list_size: int = rules.CALL_LIST_SIZE) -> list[Q.TableChecks]:
    nn, acc = Q.not_null_failure, Q.accepted_failure
    lo, hi = rules.SCORE_RANGE
    clin = g["stg_clinicians"]
    return [
        Q.TableChecks("stg_clinicians", clin, {
            "not_null_stg_clinicians_clinician_id": nn("clinician_id"),
            "not_null_stg_clinicians_signup_date": nn("signup_date"),
            "not_null_stg_clinicians_specialty": nn("specialty"),
            "not_null_stg_clinicians_state": nn("state"),
            "not_null_stg_clinicians_practice_size": nn("practice_size"),
            "accepted_values_stg_clinicians_practice_size": acc("practice_size", rules.PRACTICE_SIZES),
            "not_null_stg_clinicians_converted_to_enterprise": nn("converted_to_enterprise"),
        }, unique_keys=["clinician_id"]),
        Q.TableChecks("stg_usage_metrics", g["stg_usage_metrics"], {
            "not_null_stg_usage_metrics_clinician_id": nn("clinician_id"),
            "not_null_stg_usage_metrics_logins_per_week": nn("logins_per_week"),
            "expression_is_true_stg_usage_metrics_logins_per_week": Q.expression_failure("logins_per_week >= 0"),
            "not_null_stg_usage_metrics_days_since_last_login": nn("days_since_last_login"),
        }, unique_keys=["clinician_id"], foreign_keys=[("clinician_id", clin, "stg_clinicians")]),
        Q.TableChecks("stg_firmographic_enrichment", g["stg_firmographic_enrichment"], {
            "not_null_stg_firmographic_enrichment_clinician_id": nn("clinician_id"),
        }, unique_keys=["clinician_id"], foreign_keys=[("clinician_id", clin, "stg_clinicians")]),
        Q.TableChecks("int_clinician_engagement", g["int_clinician_engagement"], {
            "not_null_int_clinician_engagement_clinician_id": nn("clinician_id"),
            "not_null_int_clinician_engagement_recency_score": nn("recency_score"),
            "not_null_int_clinician_engagement_frequency_score": nn("frequency_score"),
            "not_null_int_clinician_engagement_expansion_score": nn("expansion_score"),
            "not_null_int_clinician_engagement_engagement_tier": nn("engagement_tier"),
            "accepted_values_int_clinician_engagement_engagement_tier": acc("engagement_tier", rules.ENGAGEMENT_TIERS),
        }, unique_keys=["clinician_id"]),
        Q.TableChecks("int_clinician_firmographic_score", g["int_clinician_firmographic_score"], {
            "not_null_int_clinician_firmographic_score_clinician_id": nn("clinician_id"),
            "not_null_int_clinician_firmographic_score_firmographic_score": nn("firmographic_score"),
        }, unique_keys=["clinician_id"]),
        Q.TableChecks("int_clinician_features", g["int_clinician_features"], {
            "not_null_int_clinician_features_clinician_id": nn("clinician_id"),
            "not_null_int_clinician_features_behavioral_score": nn("behavioral_score"),
            "not_null_int_clinician_features_firmographic_score": nn("firmographic_score"),
        }, unique_keys=["clinician_id"]),
        Q.TableChecks("mart_conversion_features", g["mart_conversion_features"], {
            "not_null_mart_conversion_features_clinician_id": nn("clinician_id"),
            "not_null_mart_conversion_features_baseline_propensity_score": nn("baseline_propensity_score"),
            "not_null_mart_conversion_features_engagement_tier": nn("engagement_tier"),
            "accepted_values_mart_conversion_features_engagement_tier": acc("engagement_tier", rules.ENGAGEMENT_TIERS),
            "not_null_mart_conversion_features_converted_to_enterprise": nn("converted_to_enterprise"),
            "assert_scores_in_range": Q.range_failure("baseline_propensity_score", lo, hi),
        }, unique_keys=["clinician_id"]),
        Q.TableChecks("mart_weekly_call_list", g["mart_weekly_call_list"], {
            "not_null_mart_weekly_call_list_call_rank": nn("call_rank"),
            "not_null_mart_weekly_call_list_clinician_id": nn("clinician_id"),
            "not_null_mart_weekly_call_list_sales_angle": nn("sales_angle"),
        }, unique_keys=["call_rank", "clinician_id"], aggregates={
            # 1 failure when the list does not hold exactly k rows
            "assert_exactly_80_calls": F.when(F.count(F.lit(1)) != call_list_size, 1).otherwise(0),
        }),
    ]


def run_all(g: dict[str, DataFrame]) -> DataFrame:
    return Q.run_suite(suite_spec(g))
