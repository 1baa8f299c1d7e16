"""Parametric scoring operators (D1-D14).  Each returns a ``Column``, so
they compose into one projection that Catalyst compiles in whole-stage
codegen; none is a Python UDF."""

from __future__ import annotations

from decimal import Decimal
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from propensa import rules
from propensa.functions.scalar import col, dec, round_half_up


def bucket_score(c: str | Column, buckets: Sequence[tuple[float, int]] = rules.RECENCY_BUCKETS,
                 default: int = rules.RECENCY_DEFAULT) -> Column:
    """Searched CASE: first ``c <= bound`` wins; NULL falls to ``default``."""
    x = col(c)
    out = None
    for bound, points in buckets:
        out = F.when(x <= bound, F.lit(points)) if out is None else out.when(x <= bound, F.lit(points))
    return out.otherwise(F.lit(default))


def capped_linear(c: str | Column, weight: int = rules.FREQUENCY_WEIGHT, cap: int = rules.SCORE_CAP) -> Column:
    """``least(cap, c * weight)``; ``least`` skips NULLs, so NULL -> cap."""
    return F.least(F.lit(cap), col(c) * weight)


def capped_sum(terms: Iterable[Column], cap: int = rules.SCORE_CAP) -> Column:
    """``least(cap, t1 + t2 + ...)``; no lower clamp."""
    total = None
    for t in terms:
        total = t if total is None else total + t
    return F.least(F.lit(cap), total)


def expansion_score(invites: str | Column = "team_members_invited", api: str | Column = "api_calls_per_week",
                    features: str | Column = "features_used_count") -> Column:
    return capped_sum([
        col(invites) * rules.EXPANSION_INVITE_WEIGHT,
        F.when(col(api) > 0, F.lit(rules.EXPANSION_API_BONUS)).otherwise(F.lit(0)),
        (col(features) - 1) * rules.EXPANSION_FEATURE_WEIGHT,
    ])


def engagement_tier(logins: str | Column = "logins_per_week", invites: str | Column = "team_members_invited",
                    api: str | Column = "api_calls_per_week") -> Column:
    """Tier by first matching rule; comparisons with NULL are not true, so
    a NULL row falls through to the last tier."""
    lg, inv, ap = col(logins), col(invites), col(api)
    return (F.when((ap > 0) & (inv >= 3) & (lg >= 5), rules.TIER_CHAMPION)
            .when((lg >= 5) & ((inv >= 2) | (ap > 0)), rules.TIER_POWER_USER)
            .when(lg >= 3, rules.TIER_ACTIVE)
            .when(lg >= 1, rules.TIER_CASUAL)
            .otherwise(rules.TIER_DORMANT))


def lookup_score(c: str | Column, mapping: Mapping[str, int], default: int) -> Column:
    """Simple CASE over a small literal map (no join needed for a handful
    of keys); unmapped values and NULL get ``default``."""
    x = col(c)
    out = None
    for key, points in mapping.items():
        out = F.when(x == key, F.lit(points)) if out is None else out.when(x == key, F.lit(points))
    return out.otherwise(F.lit(default))


def log_score(c: str | Column, weight: Decimal = rules.VOLUME_LOG_WEIGHT, cap: int = rules.SCORE_CAP) -> Column:
    """``least(cap, ln(greatest(c, 1)) * weight)``; NULL -> ln(1) = 0."""
    return F.least(F.lit(cap), F.ln(F.greatest(col(c), F.lit(1))) * dec(weight))


def weighted_sum(weights: Mapping[str, Decimal], extra: Iterable[Column] = ()) -> Column:
    """``sum(col * weight) + extra terms`` in the given order (the order
    fixes the floating-point result)."""
    total = None
    for name, w in weights.items():
        term = F.col(name) * dec(w)
        total = term if total is None else total + term
    for t in extra:
        total = t if total is None else total + t
    return total


def flag(cond: Column) -> Column:
    """CASE WHEN cond THEN true ELSE false: NULL becomes false."""
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def power_user_flag(invites: str | Column = "team_members_invited", api: str | Column = "api_calls_per_week") -> Column:
    return flag((col(invites) >= rules.POWER_USER_MIN_INVITES) & (col(api) > 0))


def at_risk_flag(idle: str | Column = "days_since_last_login") -> Column:
    return flag(col(idle) > rules.AT_RISK_IDLE_DAYS)


def firmographic_score(weights: Mapping[str, Decimal] = rules.FIRMOGRAPHIC_WEIGHTS) -> Column:
    return round_half_up(weighted_sum(weights), 2)


def behavioral_score(weights: Mapping[str, Decimal] = rules.BEHAVIORAL_WEIGHTS) -> Column:
    """Exact decimal weighted sum of integer scores, rounded to 2 places."""
    return F.round(weighted_sum(weights), 2)


def baseline_score(weights: Mapping[str, Decimal] = rules.BASELINE_WEIGHTS,
                   bonus: Decimal = rules.POWER_USER_BONUS, penalty: Decimal = rules.AT_RISK_PENALTY) -> Column:
    raw = (weighted_sum(weights)
           + F.when(F.col("is_power_user"), dec(bonus)).otherwise(dec("0.0"))
           - F.when(F.col("is_at_risk"), dec(penalty)).otherwise(dec("0.0")))
    return round_half_up(raw, 2)


def route_label(rules_: Sequence[tuple[Column, str]], default: str) -> Column:
    """First matching rule's label, else ``default``."""
    out = None
    for cond, label in rules_:
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(default) if out is not None else F.lit(default)


def sales_angle(texts: Sequence[str] = rules.SALES_ANGLES) -> Column:
    """Talk-track label by the account's dominant signal."""
    return route_label([
        (F.col("api_calls_per_week") > 0, texts[0]),
        (F.col("team_members_invited") >= rules.SALES_ANGLE_MIN_INVITES, texts[1]),
        (F.col("features_used_count") >= rules.SALES_ANGLE_MIN_FEATURES, texts[2]),
        (F.col("logins_per_week") >= rules.SALES_ANGLE_MIN_LOGINS, texts[3]),
        (F.col("practice_size").isin(*rules.LARGE_PRACTICES), texts[4]),
    ], texts[5])
