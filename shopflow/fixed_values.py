"""Labels, texts, cut-offs and tags that appear in result tables."""

from __future__ import annotations

# view-depth bands: (views below, label), then the open band
INTENT_STEPS = ((2, "1 view"), (4, "2-3 views"), (10, "4-9 views"))
INTENT_LAST = "10+ views"

# price bands: (price below, label), then the open band, which also takes NULL
PRICE_STEPS = (
    (10, "1. under 10"),
    (25, "2. 10-25"),
    (50, "3. 25-50"),
    (100, "4. 50-100"),
    (500, "5. 100-500"),
    (1000, "6. 500-1000"),
)
PRICE_LAST = "7. 1000+"

# buyer segments: (purchases below, label), then the open segment
BUYER_STEPS = ((1, "0 - browsed only"), (2, "1 purchase"), (6, "2-5 purchases"))
BUYER_LAST = "6+ purchases"

ANCHOR_CATEGORY = "electronics.smartphone"

PRICE_MOVE_PCT = 5

RECOVERY_NONE = "NOT RECOVERABLE - id sets are disjoint; fix must come from source catalog"
RECOVERY_PARTIAL = "PARTIALLY RECOVERABLE - backfill possible for the overlapping ids"

MEGA_CUTS = 3000
ELEVATED_CUTS = 2118
TIER_MEGA = "1. mega sale day (Black Friday / Cyber Monday)"
TIER_ELEVATED = "2. elevated (top decile, not mega)"
TIER_BACKGROUND = "3. background / isolated"

SPLIT_DATE = "2019-11-01"
RECENCY_ANCHOR = "2019-12-01"
COHORT_RETURNING = "returning (first seen October)"
COHORT_NEW = "new to November"

FUNNEL_STAGES = (
    ("1. Viewed", "sessions_with_view"),
    ("2. Added to cart", "sessions_with_cart"),
    ("3. Purchased", "sessions_with_purchase"),
)

# data-quality checks: name -> (description, business impact)
QUALITY_TEXTS = {
    "missing_category_code": (
        "Rows with no category_code",
        "Category-level revenue and conversion undercount; unlabeled products are bucketed as unknown",
    ),
    "missing_brand": (
        "Rows with no brand",
        "Brand performance excludes these rows entirely; brand ranking is biased toward well-tagged brands",
    ),
    "purchase_without_cart": (
        "Sessions with a purchase but no cart event",
        "Cart step is under-logged. A naive view>cart>purchase funnel yields >100% cart-to-purchase "
        "and understates cart adds. Funnel must be computed monotonically",
    ),
    "purchase_without_view": (
        "Sessions with a purchase but no view event",
        "Small volume, but indicates sessions starting mid-journey (deep link, resumed session) - "
        "top of funnel is slightly understated",
    ),
    "zero_or_negative_price": (
        "Event rows with price <= 0",
        "Free or mispriced items distort AOV and revenue if not excluded from pricing analysis",
    ),
    "multiday_sessions": (
        "Sessions spanning more than 24 hours",
        "user_session ids are reused across visits, inflating session duration and depressing "
        "per-session conversion",
    ),
}

CATALOG = "ecommerce"

# classification tags: (schema, table, column) -> tags
COLUMN_TAGS = {
    ("bronze", "events", "user_id"): {"pii": "pseudonymous_id", "sensitivity": "confidential"},
    ("silver", "fact_events", "user_id"): {"pii": "pseudonymous_id", "sensitivity": "confidential"},
    ("silver", "fact_events", "user_session"): {"pii": "pseudonymous_id", "sensitivity": "internal"},
    ("silver", "dim_session", "user_id"): {"pii": "pseudonymous_id", "sensitivity": "confidential"},
    ("gold", "user_summary", "user_id"): {"pii": "pseudonymous_id", "sensitivity": "confidential"},
    ("gold", "user_summary", "total_spend"): {"sensitivity": "confidential"},
}

TABLE_TAGS = {
    ("silver", "fact_events"): {"layer": "silver", "domain": "clickstream", "contains_pii": "true"},
    ("gold", "user_summary"): {"layer": "gold", "domain": "customer", "contains_pii": "true"},
    ("gold", "funnel"): {"layer": "gold", "domain": "conversion", "contains_pii": "false"},
    ("gold", "data_quality"): {"layer": "gold", "domain": "observability"},
}

JOB_NAME = "ecommerce-medallion-refresh"

# alert thresholds
CART_GAP_LIMIT = 60.0
STALE_HOURS_LIMIT = 36.0
UNLABELED_LIMIT = 40.0

DRIFT_THRESHOLD_PCT = 10.0
