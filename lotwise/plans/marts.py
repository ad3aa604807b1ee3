"""Semantic marts (K1-K3).

Scale notes: each mart aggregates the event fact table on its own key
*before* joining the dimension (partial aggregation happens map-side, so a
hot session or car collapses to one row per map task before the shuffle); the
join that follows is one row per key on the aggregated side.  Dimension joins
carry no broadcast hint: Spark broadcasts only below
``spark.sql.autoBroadcastJoinThreshold`` (and AQE re-checks the runtime size),
otherwise it sort-merge joins.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.contracts import DEEP_ENGAGEMENT_EVENTS, LEAD_EVENTS
from lotwise.functions import dround, flag

SESSION_FLAG_NAMES = ("saw_results", "viewed_car", "deep_engagement", "generated_lead",
                      "booked", "purchased")


def session_flags() -> dict:
    """Step predicates over ``event_name`` (built lazily: Columns need a session)."""
    name = F.col("event_name")
    return {
        "saw_results": name == "view_search_results",
        "viewed_car": name == "view_item",
        "deep_engagement": name.isin(*DEEP_ENGAGEMENT_EVENTS),
        "generated_lead": name.isin(*LEAD_EVENTS),
        "booked": name == "booking_complete",
        "purchased": name == "purchase",
    }


def session_event_rollup(events: DataFrame) -> DataFrame:
    """Per-session event count, engagement and step flags (one pass over events)."""
    return events.groupBy("session_id").agg(
        F.count("event_id").alias("event_count"),
        F.sum(F.coalesce(F.col("engagement_time_seconds"), F.lit(0.0))).alias("engagement_seconds"),
        *[F.max(flag(pred)).alias(name) for name, pred in session_flags().items()],
    )


def session_funnel(sessions: DataFrame, events: DataFrame) -> DataFrame:
    """K1 ``mart_session_funnel``: one row per session.

    Sessions without events keep NULL step flags (MAX over no rows), zero
    counts and zero engagement, as a LEFT JOIN + GROUP BY gives."""
    rolled = session_event_rollup(events)
    s = sessions.select("session_id", "user_id", "campaign_id", "session_start",
                        "device_category", "city", "is_returning_user")
    return s.join(rolled, "session_id", "left").select(
        "session_id", "user_id", "campaign_id", "session_start", "device_category", "city",
        "is_returning_user",
        F.coalesce("event_count", F.lit(0)).cast("long").alias("event_count"),
        dround(F.coalesce("engagement_seconds", F.lit(0.0)), 6).alias("engagement_seconds"),
        *[F.col(name).cast("int").alias(name) for name in SESSION_FLAG_NAMES],
    )


CAR_EVENT_COUNTS = {
    "detail_views": "view_item",
    "inspection_views": "view_inspection_report",
    "wishlists": "add_to_wishlist",
    "bookings": "booking_complete",
    "purchases": "purchase",
}


def car_performance(cars: DataFrame, events: DataFrame) -> DataFrame:
    """K2 ``mart_car_performance``: filtered event counts per car."""
    per_car = (events.filter(F.col("car_id").isNotNull()
                             & F.col("event_name").isin(*CAR_EVENT_COUNTS.values()))
               .groupBy("car_id")
               .agg(*[F.count(F.when(F.col("event_name") == ev, F.col("event_id"))).alias(name)
                      for name, ev in CAR_EVENT_COUNTS.items()]))
    c = cars.select("car_id", "make", "model", "body_type", "city", "listed_price",
                    "inspection_score", "days_in_inventory", "sold_flag")
    return c.join(per_car, "car_id", "left").select(
        *c.columns, *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in CAR_EVENT_COUNTS])


def campaign_daily(funnel: DataFrame, campaigns: DataFrame) -> DataFrame:
    """K3 ``mart_campaign_daily``: (date, campaign) outcomes and click cost.

    Aggregated to (date, campaign) first, then joined to the campaign dimension
    (inner join, as in the reference)."""
    daily = (funnel.filter(F.col("campaign_id").isNotNull())
             .groupBy(F.to_date("session_start").alias("activity_date"), "campaign_id")
             .agg(F.count(F.lit(1)).alias("sessions"),
                  F.sum("deep_engagement").alias("qualified_sessions"),
                  F.sum("generated_lead").alias("leads"),
                  F.sum("booked").alias("bookings"),
                  F.sum("purchased").alias("purchases")))
    c = campaigns.select("campaign_id", "campaign_name", "channel", "cost_per_click")
    return daily.join(c, "campaign_id", "inner").select(
        "activity_date", "campaign_id", "campaign_name", "channel",
        F.col("sessions").cast("long").alias("sessions"),
        F.col("qualified_sessions").cast("long").alias("qualified_sessions"),
        F.col("leads").cast("long").alias("leads"),
        F.col("bookings").cast("long").alias("bookings"),
        F.col("purchases").cast("long").alias("purchases"),
        (F.col("sessions") * F.col("cost_per_click")).alias("estimated_click_cost"),
    )
