"""Scoring rules of the lead-scoring pipeline.

Every scoring operator in :mod:`propensa.functions.scoring` is parametric;
this module holds the default parameters.  All weights are ``Decimal`` so
that ``int * weight`` stays an exact decimal product, as it is in SQL.
"""

from __future__ import annotations

from decimal import Decimal

# --- Fixed values: these must equal the reference's for right results. ---

# Recency score: (days_since_last_login <= bound -> points), first match wins.
RECENCY_BUCKETS = [(2, 100), (7, 85), (14, 65), (30, 40), (60, 20)]
RECENCY_DEFAULT = 0

# Frequency score: least(100, logins_per_week * 10).
FREQUENCY_WEIGHT = 10
SCORE_CAP = 100

# Expansion score: least(100, invites * 12 + (api > 0 ? 28 : 0) + (features - 1) * 5).
EXPANSION_INVITE_WEIGHT = 12
EXPANSION_API_BONUS = 28
EXPANSION_FEATURE_WEIGHT = 5

# Engagement tiers, first match wins.
TIER_CHAMPION = "Champion"
TIER_POWER_USER = "Power User"
TIER_ACTIVE = "Active"
TIER_CASUAL = "Casual"
TIER_DORMANT = "Dormant"
ENGAGEMENT_TIERS = ["Champion", "Power User", "Active", "Casual", "Dormant"]

PRACTICE_SIZES = ["Solo", "Small (2-10)", "Medium (11-50)", "Large (51-200)", "Enterprise (200+)"]
PRACTICE_SIZE_SCORES = {
    "Solo": 10,
    "Small (2-10)": 30,
    "Medium (11-50)": 55,
    "Large (51-200)": 78,
    "Enterprise (200+)": 96,
}
PRACTICE_SIZE_DEFAULT = 20

EHR_MATURITY_SCORES = {
    "Epic": 92,
    "Cerner": 82,
    "Athenahealth": 72,
    "eClinicalWorks": 56,
    "Allscripts": 50,
    "Practice Fusion": 40,
    "DrChrono": 44,
    "Other": 32,
    "None": 18,
}
EHR_MATURITY_DEFAULT = 30

SPECIALTY_NEED_SCORES = {
    "Oncology": 92,
    "Psychiatry": 88,
    "Cardiology": 82,
    "Endocrinology": 76,
    "Neurology": 72,
    "Internal Medicine": 66,
    "Pediatrics": 62,
    "Primary Care": 56,
    "Gynecology": 50,
    "Urology": 50,
    "Dermatology": 38,
    "Orthopedics": 34,
}
SPECIALTY_NEED_DEFAULT = 48

# Patient volume score: least(100, ln(greatest(volume, 1)) * 8.5).
VOLUME_LOG_WEIGHT = Decimal("8.5")

FIRMOGRAPHIC_WEIGHTS = {
    "practice_size_score": Decimal("0.32"),
    "ehr_maturity_score": Decimal("0.22"),
    "specialty_need_score": Decimal("0.26"),
    "patient_volume_score": Decimal("0.20"),
}
BEHAVIORAL_WEIGHTS = {
    "expansion_score": Decimal("0.42"),
    "frequency_score": Decimal("0.30"),
    "recency_score": Decimal("0.28"),
}
BASELINE_WEIGHTS = {
    "behavioral_score": Decimal("0.45"),
    "firmographic_score": Decimal("0.42"),
}
POWER_USER_BONUS = Decimal("13.0")
AT_RISK_PENALTY = Decimal("8.0")

# Flags.
POWER_USER_MIN_INVITES = 3
AT_RISK_IDLE_DAYS = 30

# Call-list eligibility and size.
MAX_IDLE_DAYS = 60
MIN_TENURE_DAYS = 14
CALL_LIST_SIZE = 80

# Score range accepted by the data-quality test.
SCORE_RANGE = (0, 128)

LARGE_PRACTICES = ["Large (51-200)", "Enterprise (200+)"]

# Sales-angle texts (SQL call list wording), in rule order; the last is the default.
SALES_ANGLES = [
    "API power user — lead with integrations, SLA, and developer support",
    "Growing team — lead with multi-seat pricing, RBAC, and collaboration",
    "Feature explorer — lead with advanced workflows and automation",
    "Daily-active champion — lead with productivity ROI",
    "Enterprise account — lead with compliance, SSO, dedicated support",
    "Engaged free user — lead with ROI case study and onboarding offer",
]
# Sales-angle texts of the ML call list, in the same rule order.
ML_SALES_ANGLES = [
    "API power user — lead with integrations, SLA, and developer support",
    "Growing team — lead with multi-seat pricing, RBAC, and collaboration",
    "Feature explorer — lead with advanced workflows and automation",
    "Daily-active champion — lead with productivity and time savings",
    "Enterprise account — lead with compliance, SSO, and dedicated support",
    "Engaged free-tier user — lead with ROI case study and onboarding offer",
]
SALES_ANGLE_MIN_INVITES = 5
SALES_ANGLE_MIN_FEATURES = 8
SALES_ANGLE_MIN_LOGINS = 7

# Model features, in the order the model sees them.
FEATURE_COLS = [
    "logins_per_week",
    "days_since_last_login",
    "team_members_invited",
    "api_calls_per_week",
    "features_used_count",
    "support_tickets_l90d",
    "video_consults_per_week",
    "async_messages_per_week",
    "days_on_platform",
    "recency_score",
    "frequency_score",
    "expansion_score",
    "behavioral_score",
    "firmographic_score",
    "practice_size_score",
    "ehr_maturity_score",
    "specialty_need_score",
    "is_power_user",
    "is_at_risk",
    "has_billing_system",
    "accepts_insurance",
    "is_group_practice",
    "num_locations",
]
BOOL_FEATURE_COLS = ["is_power_user", "is_at_risk", "has_billing_system", "accepts_insurance", "is_group_practice"]
TARGET_COL = "converted_to_enterprise"

# Gradient-boosted classifier settings.
GBT_PARAMS = {
    "maxIter": 300,
    "stepSize": 0.04,
    "maxDepth": 4,
    "minInstancesPerNode": 60,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "sqrt",
    "seed": 42,
    "tolerance": 1e-4,
    # rounds of the patience window; None does all rounds
    "patience": 25,
    "maxBins": 32,
}
TEST_FRACTION = Decimal("0.2")
VALIDATION_FRACTION = Decimal("0.1")
SPLIT_SEED = 42
TOP_K_METRIC = 80

# Layer namespaces.
LAYERS = ["raw", "staging", "intermediate", "marts"]
