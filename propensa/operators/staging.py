"""Staging projections (P1-P3): every raw column is cleaned by its kind.

A kind is one SQL expression, so a staging model is the same text as a DataFrame
projection and as a persistent view of the ``staging`` namespace.  Pure projections:
they inline into every consumer's scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

#: What becomes of a column of each kind.  A malformed date is NULL; a malformed number
#: fails (ANSI casts); ``trim`` takes spaces only; counts are 64-bit, so that a hot key
#: cannot overflow them.
KINDS = {
    "key": "{c}",
    "date": "try_cast({c} AS date)",
    "text": "trim({c})",
    "code": "upper(trim({c}))",
    "count": "cast({c} AS bigint)",
    "number": "cast({c} AS int)",
    "flag": "cast({c} AS boolean)",
}

# The raw columns are given, in their order.
#: staging model -> (raw input, kind of each column)
MODELS: dict[str, tuple[str, dict[str, str]]] = {
    "stg_clinicians": ("clinicians", {
        "clinician_id": "key", "signup_date": "date", "specialty": "text", "state": "code", "ehr_system": "text",
        "practice_size": "text", "org_type": "text", "annual_patient_volume": "count", "converted_to_enterprise": "flag",
        "conversion_date": "date",
    }),
    "stg_usage_metrics": ("usage_metrics", {
        "clinician_id": "key", "snapshot_date": "date", "logins_per_week": "count", "days_since_last_login": "count",
        "team_members_invited": "count", "api_calls_per_week": "count", "features_used_count": "count",
        "support_tickets_l90d": "count", "video_consults_per_week": "count", "async_messages_per_week": "count",
        "days_on_platform": "count",
    }),
    "stg_firmographic_enrichment": ("firmographic_enrichment", {
        "clinician_id": "key", "annual_patient_volume": "count", "revenue_band": "text", "num_locations": "number",
        "has_billing_system": "flag", "accepts_insurance": "flag", "is_group_practice": "flag",
    }),
}


def expressions(model: str) -> list[str]:
    return [f"{KINDS[kind].format(c=c)} AS {c}" for c, kind in MODELS[model][1].items()]


def view_sql(model: str, raw: str) -> str:
    """The query of a staging view over a raw table."""
    return f"SELECT {', '.join(expressions(model))} FROM {raw}"


def stage(model: str, raw: DataFrame) -> DataFrame:
    """A staging model of a raw frame."""
    return raw.selectExpr(*expressions(model))


def stg_clinicians(raw: DataFrame) -> DataFrame:
    return stage("stg_clinicians", raw)


def stg_usage_metrics(raw: DataFrame) -> DataFrame:
    return stage("stg_usage_metrics", raw)


def stg_firmographic_enrichment(raw: DataFrame) -> DataFrame:
    return stage("stg_firmographic_enrichment", raw)
