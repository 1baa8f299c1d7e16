"""The model graph (D15-D19): engagement, firmographic scores, feature
table, conversion mart and weekly call list.

Each function takes and returns lazy DataFrames; chained together they form
one plan.  Both joins are left joins on ``clinician_id``; when the inputs
are bucketed scans of the seed table (see ``sources.seeds``) the planner
needs no exchange for either of them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensa import rules
from propensa.functions import scoring as S
from propensa.operators.rank import score_order, top_k

USAGE_COLS = [
    "clinician_id", "snapshot_date", "logins_per_week", "days_since_last_login",
    "team_members_invited", "api_calls_per_week", "features_used_count",
    "support_tickets_l90d", "video_consults_per_week", "async_messages_per_week",
    "days_on_platform",
]


def engagement(stg_usage: DataFrame) -> DataFrame:
    """Recency / frequency / expansion scores and the engagement tier."""
    return stg_usage.select(
        *USAGE_COLS,
        S.bucket_score("days_since_last_login").alias("recency_score"),
        S.capped_linear("logins_per_week").alias("frequency_score"),
        S.expansion_score().alias("expansion_score"),
        S.engagement_tier().alias("engagement_tier"),
    )


def firmographic(stg_clinicians: DataFrame, stg_firmographics: DataFrame) -> DataFrame:
    """Clinicians left-joined to enrichment (J1) plus the firmographic
    sub-scores and their weighted composite."""
    c = stg_clinicians.alias("c")
    f = stg_firmographics.alias("f")
    joined = c.join(f, F.col("c.clinician_id") == F.col("f.clinician_id"), "left").select(
        F.col("c.clinician_id"), F.col("c.specialty"), F.col("c.state"), F.col("c.ehr_system"),
        F.col("c.practice_size"), F.col("c.org_type"), F.col("c.signup_date"),
        F.col("c.converted_to_enterprise"), F.col("c.conversion_date"),
        F.col("f.annual_patient_volume"), F.col("f.revenue_band"), F.col("f.num_locations"),
        F.col("f.has_billing_system"), F.col("f.accepts_insurance"), F.col("f.is_group_practice"),
        S.lookup_score("c.practice_size", rules.PRACTICE_SIZE_SCORES, rules.PRACTICE_SIZE_DEFAULT)
        .alias("practice_size_score"),
        S.lookup_score("c.ehr_system", rules.EHR_MATURITY_SCORES, rules.EHR_MATURITY_DEFAULT)
        .alias("ehr_maturity_score"),
        S.lookup_score("c.specialty", rules.SPECIALTY_NEED_SCORES, rules.SPECIALTY_NEED_DEFAULT)
        .alias("specialty_need_score"),
    )
    with_volume = joined.withColumn("patient_volume_score", S.log_score("annual_patient_volume"))
    return with_volume.withColumn("firmographic_score", S.firmographic_score())


def features(firmo: DataFrame, eng: DataFrame) -> DataFrame:
    """Firmographic left-joined to engagement (J2), the behavioral
    composite and the two routing flags."""
    f = firmo.alias("f")
    e = eng.alias("e")
    joined = f.join(e, F.col("f.clinician_id") == F.col("e.clinician_id"), "left").select(
        *[F.col(f"f.{c}") for c in [
            "clinician_id", "signup_date", "specialty", "state", "ehr_system", "practice_size",
            "org_type", "annual_patient_volume", "num_locations", "revenue_band",
            "converted_to_enterprise", "has_billing_system", "accepts_insurance", "is_group_practice"]],
        *[F.col(f"e.{c}") for c in [
            "logins_per_week", "days_since_last_login", "team_members_invited", "api_calls_per_week",
            "features_used_count", "support_tickets_l90d", "video_consults_per_week",
            "async_messages_per_week", "days_on_platform", "engagement_tier",
            "recency_score", "frequency_score", "expansion_score"]],
        *[F.col(f"f.{c}") for c in [
            "practice_size_score", "ehr_maturity_score", "specialty_need_score", "firmographic_score"]],
    )
    return joined.select(
        "*",
        S.behavioral_score().alias("behavioral_score"),
        S.power_user_flag().alias("is_power_user"),
        S.at_risk_flag().alias("is_at_risk"),
    )


MART_COLS = [
    "clinician_id", "signup_date", "specialty", "state", "ehr_system", "practice_size", "org_type",
    "annual_patient_volume", "num_locations", "revenue_band", "converted_to_enterprise",
    "logins_per_week", "days_since_last_login", "team_members_invited", "api_calls_per_week",
    "features_used_count", "support_tickets_l90d", "video_consults_per_week",
    "async_messages_per_week", "days_on_platform",
    "recency_score", "frequency_score", "expansion_score", "behavioral_score", "firmographic_score",
    "practice_size_score", "ehr_maturity_score", "specialty_need_score",
    "is_power_user", "is_at_risk", "has_billing_system", "accepts_insurance", "is_group_practice",
    "engagement_tier",
]


def _stamp(as_of: dt.date | dt.datetime | None) -> Column:
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if not isinstance(as_of, dt.datetime):
        as_of = dt.datetime(as_of.year, as_of.month, as_of.day)
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def _date(as_of: dt.date | dt.datetime | None) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, dt.datetime):
        as_of = as_of.date()
    return F.lit(as_of)


def conversion_mart(feats: DataFrame, as_of: dt.date | dt.datetime | None = None) -> DataFrame:
    """The feature mart with the baseline propensity score.  No global
    ORDER BY is kept: sort at read time (``rank.sorted_by_score``)."""
    return feats.select(
        *MART_COLS,
        S.baseline_score().alias("baseline_propensity_score"),
        _stamp(as_of).alias("scored_at"),
    )


def eligible(mart: DataFrame, max_idle: int = rules.MAX_IDLE_DAYS, min_tenure: int = rules.MIN_TENURE_DAYS) -> DataFrame:
    """Not converted, active within ``max_idle`` days, on the platform at
    least ``min_tenure`` days.  NULLs fail every comparison."""
    return mart.filter(
        (F.col("converted_to_enterprise") == F.lit(False))
        & (F.col("days_since_last_login") <= max_idle)
        & (F.col("days_on_platform") >= min_tenure)
    )


CALL_LIST_COLS = [
    "call_rank", "clinician_id", "specialty", "state", "ehr_system", "practice_size", "org_type",
    "annual_patient_volume", "revenue_band", "logins_per_week", "days_since_last_login",
    "team_members_invited", "api_calls_per_week", "features_used_count", "is_power_user",
    "engagement_tier", "baseline_propensity_score", "sales_angle", "call_list_date",
]


def call_list(mart: DataFrame, k: int = rules.CALL_LIST_SIZE, as_of: dt.date | None = None,
              score: str = "baseline_propensity_score") -> DataFrame:
    """D19 (flagship): eligibility filter, top-k by score, rank, talk track."""
    ranked = top_k(eligible(mart), k, score_order(score), rank_col="call_rank")
    return ranked.select(
        *[c for c in CALL_LIST_COLS if c not in ("sales_angle", "call_list_date")],
        S.sales_angle().alias("sales_angle"),
        _date(as_of).alias("call_list_date"),
    )


def build(stg: dict[str, DataFrame], as_of: dt.date | None = None) -> dict[str, DataFrame]:
    """The whole graph from the three staging frames."""
    eng = engagement(stg["stg_usage_metrics"])
    firmo = firmographic(stg["stg_clinicians"], stg["stg_firmographic_enrichment"])
    feats = features(firmo, eng)
    mart = conversion_mart(feats, as_of)
    return {
        "int_clinician_engagement": eng,
        "int_clinician_firmographic_score": firmo,
        "int_clinician_features": feats,
        "mart_conversion_features": mart,
        "mart_weekly_call_list": call_list(mart, as_of=as_of),
    }
