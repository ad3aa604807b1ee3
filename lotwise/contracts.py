"""Canonical marketplace table contracts and fixed domain values.

Every library function takes and returns DataFrames shaped by these
StructTypes.  Ids are strings, money is DOUBLE, timestamps are zone-less
(TIMESTAMP_NTZ).
"""
from __future__ import annotations

from pyspark.sql import types as T

S, I, D, B = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
DT, TS = T.DateType(), T.TimestampNTZType()


def _struct(spec: str, not_null: tuple[str, ...] = ()) -> T.StructType:
    kinds = {"s": S, "i": I, "d": D, "b": B, "date": DT, "ts": TS}
    fields = []
    for item in spec.split():
        name, kind = item.split(":")
        fields.append(T.StructField(name, kinds[kind], name not in not_null))
    return T.StructType(fields)


CARS = _struct(
    "car_id:s make:s model:s variant:s body_type:s fuel_type:s transmission:s "
    "manufacturing_year:i registration_year:i kilometres_driven:d owner_count:i city:s "
    "state:s engine_cc:d claimed_mileage_kmpl:d insurance_valid:b "
    "service_history_available:b accident_history:b inspection_score:d exterior_score:d "
    "interior_score:d engine_score:d tyre_score:d number_of_features:i "
    "acquisition_price:d listed_price:d inventory_entry_date:date inventory_exit_date:date "
    "sold_flag:b transaction_price:d days_in_inventory:i delivery_available:b "
    "finance_available:b model_popularity:d",
    not_null=("car_id", "make", "model"),
)

USERS = _struct(
    "user_id:s signup_date:date home_city:s age_band:s income_band:s family_size_band:s "
    "first_time_buyer_probability:d preferred_body_types:s preferred_makes:s "
    "preferred_fuel_types:s preferred_transmissions:s ideal_budget:d maximum_budget:d "
    "ideal_emi:d maximum_emi:d vehicle_age_tolerance:d kilometre_tolerance:d "
    "quality_sensitivity:d price_sensitivity:d brand_loyalty:d exploration_tendency:d "
    "finance_interest:d purchase_urgency:d",
    not_null=("user_id",),
)

CAMPAIGNS = _struct(
    "campaign_id:s campaign_name:s source:s medium:s channel:s target_city:s "
    "target_segment:s start_date:date end_date:date daily_budget:d cost_per_click:d "
    "quality_multiplier:d intent_multiplier:d inventory_match_multiplier:d",
    not_null=("campaign_id",),
)

SESSIONS = _struct(
    "session_id:s user_id:s session_start:ts session_end:ts campaign_id:s source:s "
    "medium:s device_category:s city:s is_returning_user:b session_sequence_number:i",
    not_null=("session_id", "user_id"),
)

EVENTS = _struct(
    "event_id:s event_timestamp:ts event_date:date user_id:s session_id:s event_name:s "
    "car_id:s item_list_id:s list_position:i search_term:s filter_name:s filter_value:s "
    "engagement_time_seconds:d page_location:s source:s medium:s campaign_id:s "
    "device_category:s city:s",
    not_null=("event_id", "event_timestamp", "event_date", "user_id", "session_id", "event_name"),
)

IMPRESSIONS = _struct(
    "session_id:s user_id:s car_id:s list_position:i examined:b clicked:b "
    "viewed_gallery:b viewed_inspection:b compared:b emi_calculated:b wishlisted:b "
    "callback:b booked:b purchased:b event_timestamp:ts campaign_id:s"
)

RECOMMENDATION_IMPRESSIONS = _struct(
    "recommendation_id:s model_version:s generated_at:ts user_id:s session_id:s car_id:s "
    "candidate_source:s original_rank:i final_rank:i content_score:d "
    "collaborative_score:d session_score:d ranker_score:d booking_probability:d "
    "sellthrough_probability:d predicted_fair_price:d deal_score:d inventory_priority:d "
    "final_score:d clicked:b wishlisted:b booked:b purchased:b",
    not_null=("recommendation_id", "model_version", "generated_at", "user_id", "car_id"),
)

MODEL_METRICS = _struct(
    "model_name:s version:s metric_name:s metric_value:d recorded_at:ts"
)

CONTRACTS = {
    "cars": CARS, "users": USERS, "campaigns": CAMPAIGNS, "sessions": SESSIONS,
    "events": EVENTS, "impressions": IMPRESSIONS,
    "recommendation_impressions": RECOMMENDATION_IMPRESSIONS,
    "model_metrics": MODEL_METRICS,
}

PRIMARY_KEYS = {
    "cars": ("car_id",), "users": ("user_id",), "campaigns": ("campaign_id",),
    "sessions": ("session_id",), "events": ("event_id",),
    "impressions": ("session_id", "car_id"),
}

# ---------------------------------------------------------------------------
# These must equal the reference's for identical results.
# ---------------------------------------------------------------------------

# Canonical event taxonomy (21 names).
CANONICAL_EVENTS = (
    "session_start", "view_home", "search", "apply_filter", "remove_filter",
    "view_search_results", "select_item", "view_item", "view_gallery",
    "view_inspection_report", "compare_car", "calculate_emi", "view_finance_offer",
    "add_to_wishlist", "remove_from_wishlist", "request_callback", "book_test_drive",
    "begin_checkout", "booking_complete", "purchase", "session_end",
)

# GA4 event name -> canonical event name.
GA4_EVENT_MAP = {
    "page_view": "view_home",
    "view_search_results": "view_search_results",
    "search": "search",
    "select_item": "select_item",
    "view_item": "view_item",
    "view_item_list": "view_search_results",
    "add_to_wishlist": "add_to_wishlist",
    "begin_checkout": "begin_checkout",
    "purchase": "purchase",
    "generate_lead": "request_callback",
    "session_start": "session_start",
}
GA4_REQUIRED = ("event_timestamp", "event_name", "user_pseudo_id", "ga_session_id")

BODY_TYPES = ("Hatchback", "Sedan", "Compact SUV", "SUV", "MPV")
FILTER_DIMENSIONS = ("body_type", "transmission", "max_price", "fuel_type")
DEVICE_CATEGORIES = ("mobile", "desktop", "tablet")

# Funnel step groups used by the marts and analyses.
DEEP_ENGAGEMENT_EVENTS = ("view_inspection_report", "calculate_emi", "add_to_wishlist")
LEAD_EVENTS = ("request_callback", "book_test_drive")

# Intent event weights (default 0.5 for unlisted names).
EVENT_WEIGHTS = {
    "view_search_results": 0.5, "select_item": 2.0, "view_item": 3.0,
    "view_gallery": 4.0, "view_inspection_report": 6.0, "compare_car": 7.0,
    "calculate_emi": 8.0, "add_to_wishlist": 10.0, "request_callback": 14.0,
    "book_test_drive": 18.0, "booking_complete": 22.0, "purchase": 30.0,
}
EVENT_WEIGHT_DEFAULT = 0.5
LONG_TERM_DECAY_PER_DAY = 0.03

# Collaborative-filtering interaction weights.
INTERACTION_WEIGHTS = {
    "select_item": 1.0, "view_item": 2.0, "view_gallery": 3.0,
    "view_inspection_report": 5.0, "compare_car": 6.0, "calculate_emi": 7.0,
    "add_to_wishlist": 8.0, "request_callback": 11.0, "book_test_drive": 14.0,
    "booking_complete": 18.0, "purchase": 25.0,
}

# SQL-analysis propensity by list position (positions > 10 get 0.25).
SQL_POSITION_PROPENSITY = (0.95, 0.90, 0.84, 0.77, 0.70, 0.64, 0.58, 0.53, 0.48, 0.44)
SQL_POSITION_PROPENSITY_DEFAULT = 0.25
# Ranking-model propensity by list position (20 values, clipped at both ends).
RANKING_POSITION_PROPENSITY = (0.95, 0.90, 0.84, 0.77, 0.70, 0.64, 0.58, 0.53, 0.48, 0.44,
                               0.38, 0.34, 0.30, 0.27, 0.24, 0.22, 0.20, 0.18, 0.17, 0.16)
MAX_PROPENSITY_WEIGHT = 10.0

# Feature names that would leak the label into a model.
FORBIDDEN_FEATURES = ("_latent_fair_price", "_deal_latent", "latent_fair_price",
                      "transaction_price", "inventory_exit_date", "sold_flag")

# Recommendation / reranking parameters.
RECOMMENDATION = dict(candidate_limit=150, final_limit=10, session_half_life_minutes=20,
                      content_top_k=50, collaborative_top_k=50, session_top_k=50,
                      popularity_top_k=30, inventory_top_k=20)
RERANKING = dict(ranker_weight=0.50, booking_weight=0.18, deal_weight=0.10,
                 inventory_weight=0.07, quality_weight=0.08,
                 constraint_penalty_weight=0.30, exposure_penalty_weight=0.05,
                 minimum_relevance_for_inventory_boost=0.60,
                 mmr_lambda_low_entropy=0.85, mmr_lambda_mid_entropy=0.70,
                 mmr_lambda_high_entropy=0.55)
ALS_PARAMS = dict(rank=32, reg_param=0.05, max_iter=15, alpha=20.0)

# Drift thresholds and quality gates.
MONITORING = dict(psi_warning=0.10, psi_critical=0.25, js_warning=0.10, js_critical=0.20,
                  missing_rate_delta_warning=0.05, missing_rate_delta_critical=0.15)
QUALITY_GATES = {
    "price": dict(minimum_r2=0.75, maximum_mae=180000.0, maximum_global_median_mae_ratio=0.70),
    "booking": dict(minimum_roc_auc=0.65, minimum_pr_auc_lift=1.50, minimum_top5_lift=1.50),
    "sellthrough": dict(minimum_roc_auc=0.50, minimum_pr_auc_lift=1.05, minimum_top5_lift=1.00),
    "ranking": dict(minimum_ndcg_at_10=0.50, maximum_session_baseline_degradation=0.02),
}
SPLITS = dict(train_end="2025-06-30", validation_end="2025-09-30", test_end="2025-12-31")
