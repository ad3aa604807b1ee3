"""Named analyses (K4-K17) as DataFrame plans.

Each function takes canonical DataFrames and returns one lazy DataFrame.
Orderings that the reference leaves to chance get a unique tie-break (ids), so
results are deterministic.  Event-grain work is always aggregated to its key
(session, car, purchase) before joining a dimension.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.contracts import (DEEP_ENGAGEMENT_EVENTS, SQL_POSITION_PROPENSITY,
                               SQL_POSITION_PROPENSITY_DEFAULT)
from lotwise.functions import dround, flag, months_between_boundaries, safe_div, seconds_between
from lotwise.operators.ranks import with_ntile
from lotwise.operators.selection import join_quantiles
from lotwise.plans.marts import session_event_rollup

ATTRIBUTION_WINDOW_DAYS = 30


# --------------------------------------------------------------------------- K4
def campaign_attribution(events: DataFrame, cars: DataFrame, sessions: DataFrame,
                         campaigns: DataFrame,
                         window_days: int = ATTRIBUTION_WINDOW_DAYS) -> DataFrame:
    """K4: first-, last- and linear-touch purchase attribution over sessions that
    started within ``window_days`` before the purchase.

    The range join (same user, session_start in [t - 30d, t]) is turned into an
    equi-join on (user_id, day): each purchase is replicated to the 31 candidate
    days, so a heavy user's sessions split across day keys instead of landing in
    one join task; the exact bound is then a residual filter."""
    purchases = (events.filter(F.col("event_name") == "purchase")
                 .join(cars.select("car_id", "transaction_price", "acquisition_price"), "car_id", "inner")
                 .select(F.col("event_id").alias("purchase_id"), "user_id",
                         F.col("event_timestamp").alias("purchase_timestamp"),
                         (F.col("transaction_price") - F.col("acquisition_price")).alias("gross_margin")))
    days = F.sequence(F.to_date(F.col("purchase_timestamp") - F.expr(f"INTERVAL {window_days} DAYS")),
                      F.to_date("purchase_timestamp"))
    p_days = purchases.withColumn("touch_day", F.explode(days))
    s = sessions.select("session_id", "user_id", "campaign_id", "session_start",
                        F.to_date("session_start").alias("touch_day"))
    touches = (p_days.join(s, ["user_id", "touch_day"], "inner")
               .filter((F.col("session_start") <= F.col("purchase_timestamp"))
                       & (F.col("session_start") >= F.col("purchase_timestamp")
                          - F.expr(f"INTERVAL {window_days} DAYS"))))
    w = Window.partitionBy("purchase_id")
    ordered = w.orderBy("session_start", "session_id")
    touches = (touches
               .withColumn("rn", F.row_number().over(ordered))
               .withColumn("touch_count", F.count(F.lit(1)).over(w))
               .select("campaign_id", "purchase_id", "gross_margin",
                       (F.col("rn") == 1).cast("int").alias("first_touch_credit"),
                       (F.col("rn") == F.col("touch_count")).cast("int").alias("last_touch_credit"),
                       (F.lit(1.0) / F.col("touch_count")).alias("linear_credit")))
    per_campaign = touches.groupBy("campaign_id").agg(
        F.count_distinct("purchase_id").alias("touched_purchases"),
        F.sum("first_touch_credit").alias("first_touch_purchases"),
        F.sum("last_touch_credit").alias("last_touch_purchases"),
        F.sum("linear_credit").alias("linear_attributed_purchases"),
        F.sum(F.col("gross_margin") * F.col("first_touch_credit")).alias("first_touch_margin"),
        F.sum(F.col("gross_margin") * F.col("last_touch_credit")).alias("last_touch_margin"),
        F.sum(F.col("gross_margin") * F.col("linear_credit")).alias("linear_attributed_margin"),
    )
    c = campaigns.select("campaign_id", "campaign_name", "channel")
    return per_campaign.join(c, "campaign_id", "inner").select(
        "campaign_id", "campaign_name", "channel",
        F.col("touched_purchases").cast("long").alias("touched_purchases"),
        F.col("first_touch_purchases").cast("long").alias("first_touch_purchases"),
        F.col("last_touch_purchases").cast("long").alias("last_touch_purchases"),
        dround("linear_attributed_purchases", 3).alias("linear_attributed_purchases"),
        dround("first_touch_margin", 0).alias("first_touch_margin"),
        dround("last_touch_margin", 0).alias("last_touch_margin"),
        dround("linear_attributed_margin", 0).alias("linear_attributed_margin"),
    )


# --------------------------------------------------------------------------- K5
def session_outcomes(sessions: DataFrame, events: DataFrame) -> DataFrame:
    """Per-session 0/1 outcome flags (0 when the session has no events)."""
    rolled = session_event_rollup(events)
    return sessions.join(rolled, "session_id", "left").select(
        "session_id", "user_id", "campaign_id", "device_category", "city",
        "is_returning_user", "session_start",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in
          ("saw_results", "viewed_car", "deep_engagement", "generated_lead", "booked", "purchased")])


def campaign_quality(sessions: DataFrame, events: DataFrame, cars: DataFrame,
                     campaigns: DataFrame) -> DataFrame:
    """K5: planned budget, click cost, funnel outcomes, unit economics, ROAS."""
    sess = session_outcomes(sessions, events)
    agg = sess.groupBy("campaign_id").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("deep_engagement").cast("long").alias("qualified_sessions"),
        F.sum("generated_lead").cast("long").alias("leads"),
        F.sum("booked").cast("long").alias("bookings"),
        F.sum("purchased").cast("long").alias("purchases"))
    rev = (events.filter(F.col("event_name") == "purchase")
           .join(cars.select("car_id", "transaction_price", "acquisition_price"), "car_id", "inner")
           .groupBy("campaign_id")
           .agg(F.sum(F.col("transaction_price") - F.col("acquisition_price")).alias("gross_margin")))
    c = campaigns.select("campaign_id", "campaign_name", "channel", "daily_budget",
                         "cost_per_click", "start_date", "end_date")
    j = c.join(agg, "campaign_id", "inner").join(rev, "campaign_id", "left")
    spend = F.col("sessions") * F.col("cost_per_click")
    revenue = F.coalesce(F.col("gross_margin"), F.lit(0.0))
    return j.select(
        "campaign_id", "campaign_name", "channel",
        dround(F.col("daily_budget") * F.greatest(F.datediff("end_date", "start_date") + 1, F.lit(1)), 0)
        .alias("planned_budget"),
        F.col("sessions").cast("long").alias("sessions"),
        dround(spend, 0).alias("click_cost"),
        "qualified_sessions", "leads", "bookings", "purchases",
        dround(safe_div(spend, F.col("sessions")), 2).alias("cost_per_session"),
        dround(safe_div(spend, F.col("leads")), 2).alias("cost_per_lead"),
        dround(safe_div(spend, F.col("bookings")), 2).alias("cost_per_booking"),
        dround(safe_div(F.col("bookings"), F.col("sessions")), 4).alias("conversion_rate"),
        revenue.alias("actual_revenue"),
        dround(safe_div(revenue, spend), 3).alias("actual_roas"),
    )


# --------------------------------------------------------------------------- K6
def cohort_retention(users: DataFrame, sessions: DataFrame, events: DataFrame) -> DataFrame:
    """K6: signup-month cohorts x months since signup (observed months only)."""
    rolled = session_event_rollup(events).select("session_id", "booked", "purchased")
    monthly = (sessions.select("session_id", "user_id", "session_start")
               .join(rolled, "session_id", "left")
               .groupBy("user_id", F.trunc("session_start", "MM").alias("activity_month"))
               .agg(F.count_distinct("session_id").alias("sessions"),
                    F.max("booked").alias("booked"),
                    F.max("purchased").alias("purchased")))
    cohorts = users.select("user_id", F.trunc("signup_date", "MM").alias("cohort_month"))
    size = cohorts.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_users"))
    j = (cohorts.join(monthly, "user_id", "inner").join(size, "cohort_month", "inner")
         .filter(F.col("activity_month") >= F.col("cohort_month")))
    out = j.groupBy("cohort_month",
                    months_between_boundaries(F.col("cohort_month"), F.col("activity_month"))
                    .alias("months_since_signup"),
                    "cohort_users").agg(
        F.count_distinct("user_id").alias("active_users"),
        F.sum("sessions").alias("sessions"),
        F.sum("booked").alias("users_booking"),
        F.sum("purchased").alias("users_purchasing"))
    return out.select(
        "cohort_month", "months_since_signup",
        F.col("cohort_users").cast("long").alias("cohort_users"),
        F.col("active_users").cast("long").alias("active_users"),
        dround(F.col("active_users") / F.col("cohort_users"), 4).alias("retention_rate"),
        F.col("sessions").cast("long").alias("sessions"),
        F.col("users_booking").cast("long").alias("users_booking"),
        F.col("users_purchasing").cast("long").alias("users_purchasing"))


# --------------------------------------------------------------------------- K7
def _mode_per_user(viewed: DataFrame, column: str, out: str) -> DataFrame:
    """Most frequent non-null value per user; ties -> smallest value."""
    counts = (viewed.filter(F.col(column).isNotNull())
              .groupBy("user_id", column).agg(F.count(F.lit(1)).alias("n")))
    return counts.groupBy("user_id").agg(
        F.min_by(F.col(column), F.struct((-F.col("n")).alias("neg_n"), F.col(column).alias("v")))
        .alias(out))


def customer_360(users: DataFrame, sessions: DataFrame, events: DataFrame,
                 cars: DataFrame) -> DataFrame:
    """K7: RFM-style user view, quartiles, observed preferences, lifecycle segment.

    Quartiles are NTILE(4) over (metric, user_id) computed by a distributed
    global rank, not a single-partition window."""
    rolled = session_event_rollup(events)
    per_session = (sessions.select("session_id", "user_id", "session_start")
                   .join(rolled, "session_id", "left"))
    activity = per_session.groupBy("user_id").agg(
        F.count("session_id").alias("lifetime_sessions"),
        F.max("session_start").alias("last_session_at"),
        F.count(F.when(F.col("deep_engagement") == 1, F.col("session_id"))).alias("qualified_sessions"),
        F.count(F.when(F.col("booked") == 1, F.col("session_id"))).alias("bookings"),
        F.count(F.when(F.col("purchased") == 1, F.col("session_id"))).alias("purchases"),
        F.sum(F.coalesce(F.col("engagement_seconds"), F.lit(0.0))).alias("engagement_seconds"))
    viewed = (events.filter(F.col("event_name") == "view_item").select("session_id", "car_id")
              .join(sessions.select("session_id", "user_id"), "session_id", "inner")
              .join(cars.select("car_id", "body_type", "make"), "car_id", "inner"))
    body_pref = _mode_per_user(viewed, "body_type", "observed_body_preference")
    make_pref = _mode_per_user(viewed, "make", "observed_make_preference")
    ua = (users.select("user_id", "home_city", "signup_date", "maximum_budget")
          .join(activity, "user_id", "left")
          .join(body_pref, "user_id", "left")
          .join(make_pref, "user_id", "left")
          .select("user_id", "home_city", "signup_date", "maximum_budget",
                  F.coalesce("lifetime_sessions", F.lit(0)).cast("long").alias("lifetime_sessions"),
                  "last_session_at",
                  F.coalesce("qualified_sessions", F.lit(0)).cast("long").alias("qualified_sessions"),
                  F.coalesce("bookings", F.lit(0)).cast("long").alias("bookings"),
                  F.coalesce("purchases", F.lit(0)).cast("long").alias("purchases"),
                  dround(F.coalesce("engagement_seconds", F.lit(0.0)), 6).alias("engagement_seconds"),
                  "observed_body_preference", "observed_make_preference"))
    scored = with_ntile(ua, [F.col("lifetime_sessions").asc_nulls_last(), F.col("user_id")], 4,
                        "frequency_quartile")
    scored = with_ntile(scored, [F.col("engagement_seconds").asc_nulls_last(), F.col("user_id")], 4,
                        "engagement_quartile")
    latest = users.select("user_id").join(activity.select("user_id", "last_session_at"), "user_id") \
        .agg(F.max("last_session_at").alias("__max_last"))
    scored = scored.crossJoin(F.broadcast(latest)).withColumn(
        "recency_days", F.datediff(F.to_date("__max_last"), F.to_date("last_session_at")).cast("long")
    ).drop("__max_last")
    segment = (F.when(F.col("purchases") > 0, "customer")
               .when(F.col("bookings") > 0, "booked_lead")
               .when((F.col("qualified_sessions") > 0) & (F.col("recency_days") <= 30), "hot_lead")
               .when(F.col("lifetime_sessions") > 1, "returning_browser")
               .otherwise("new_or_dormant"))
    return scored.withColumn("lifecycle_segment", segment)


# --------------------------------------------------------------------------- K8
def _last_filter_value(events: DataFrame, name: str) -> F.Column:
    pick = (F.col("filter_name") == name) & F.col("filter_value").isNotNull()
    return F.max_by(F.when(pick, F.col("filter_value")),
                    F.when(pick, F.struct("event_timestamp", "event_id")))


def demand_supply_gap(events: DataFrame, cars: DataFrame, limit: int = 100,
                      city: str | None = None, body_type: str | None = None,
                      minimum_gap: float | None = None) -> DataFrame:
    """K8 (and L3 with filters): searches per supplied car by city x body x
    transmission; a session's last applied filter defines its demand segment.

    The supply join keeps (city, body_type) as hash keys with the wildcard
    transmission as a residual, fanning an 'Any' demand row out per supplied
    transmission, as the reference does."""
    filt = events.filter(F.col("event_name") == "apply_filter")
    session_filters = filt.groupBy("session_id").agg(
        _last_filter_value(events, "body_type").alias("body_type"),
        _last_filter_value(events, "transmission").alias("transmission"))
    demand = (events.filter(F.col("event_name") == "view_search_results")
              .select("session_id", "city", "user_id")
              .join(session_filters.filter(F.col("body_type").isNotNull()), "session_id", "inner")
              .groupBy("city", "body_type",
                       F.coalesce(F.col("transmission"), F.lit("Any")).alias("transmission"))
              .agg(F.count(F.lit(1)).alias("qualified_sessions"),
                   F.count_distinct("user_id").alias("unique_users")))
    supply = (cars.filter(~F.col("sold_flag"))
              .groupBy("city", "body_type", "transmission")
              .agg(F.count(F.lit(1)).alias("available_cars")))
    supply = join_quantiles(supply, cars.filter(~F.col("sold_flag")), ["city", "body_type", "transmission"],
                            "listed_price", {"median_price": 0.5})
    d, s = demand.alias("d"), supply.alias("s")
    cond = ((F.col("d.city") == F.col("s.city")) & (F.col("d.body_type") == F.col("s.body_type"))
            & ((F.col("d.transmission") == "Any") | (F.col("s.transmission") == F.col("d.transmission"))))
    out = d.join(s, cond, "left").select(
        F.col("d.city").alias("city"), F.col("d.body_type").alias("body_type"),
        F.col("d.transmission").alias("transmission"),
        F.col("d.qualified_sessions").cast("long").alias("qualified_sessions"),
        F.col("d.unique_users").cast("long").alias("unique_users"),
        F.coalesce(F.col("s.available_cars"), F.lit(0)).cast("long").alias("available_cars"),
        dround(F.coalesce(F.col("s.median_price"), F.lit(0.0)), 0).alias("median_listed_price"),
        dround(F.col("d.qualified_sessions")
               / (F.coalesce(F.col("s.available_cars"), F.lit(0)) + 1), 2).alias("demand_supply_gap"))
    if city is not None:
        out = out.filter(F.col("city") == city)
    if body_type is not None:
        out = out.filter(F.col("body_type") == body_type)
    if minimum_gap is not None:
        out = out.filter(F.col("demand_supply_gap") >= minimum_gap)
    order = [F.col("demand_supply_gap").desc(), "city", "body_type", "transmission",
             F.col("available_cars").desc(), F.col("median_listed_price").desc()]
    return out.orderBy(*order).limit(limit) if limit else out


# --------------------------------------------------------------------------- K9
def funnel_analysis(sessions: DataFrame, events: DataFrame) -> DataFrame:
    """K9: seven step rates by campaign x device x returning flag."""
    rolled = events.groupBy("session_id").agg(
        *[F.max(flag(F.col("event_name") == ev)).alias(n) for n, ev in (
            ("saw_results", "view_search_results"), ("viewed_detail", "view_item"),
            ("viewed_inspection", "view_inspection_report"), ("calculated_emi", "calculate_emi"),
            ("wishlisted", "add_to_wishlist"), ("booked", "booking_complete"),
            ("purchased", "purchase"))])
    steps = ("saw_results", "viewed_detail", "viewed_inspection", "calculated_emi", "wishlisted",
             "booked", "purchased")
    sess = (sessions.select("session_id", "campaign_id", "device_category", "is_returning_user")
            .join(rolled, "session_id", "left")
            .select("campaign_id", "device_category", "is_returning_user",
                    *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in steps]))
    g = sess.groupBy("campaign_id", "device_category", "is_returning_user").agg(
        F.count(F.lit(1)).alias("sessions"), F.avg("saw_results").alias("results_rate"),
        *[F.sum(c).alias(f"n_{c}") for c in steps])
    return g.select(
        "campaign_id", "device_category", "is_returning_user",
        F.col("sessions").cast("long").alias("sessions"),
        dround("results_rate", 4).alias("session_to_results_rate"),
        dround(safe_div(F.col("n_viewed_detail"), F.col("n_saw_results")), 4).alias("results_to_detail_rate"),
        dround(safe_div(F.col("n_viewed_inspection"), F.col("n_viewed_detail")), 4).alias("detail_to_inspection_rate"),
        dround(safe_div(F.col("n_calculated_emi"), F.col("n_viewed_detail")), 4).alias("detail_to_emi_rate"),
        dround(safe_div(F.col("n_wishlisted"), F.col("n_viewed_detail")), 4).alias("detail_to_wishlist_rate"),
        dround(safe_div(F.col("n_booked"), F.col("n_viewed_detail")), 4).alias("detail_to_booking_rate"),
        dround(safe_div(F.col("n_purchased"), F.col("n_booked")), 4).alias("booking_to_purchase_rate"))


# -------------------------------------------------------------------------- K10
def funnel_transition_times(sessions: DataFrame, events: DataFrame) -> DataFrame:
    """Median / p90 whole-second gaps between funnel steps (exact quantiles)."""
    first_at = events.groupBy("session_id").agg(
        *[F.min(F.when(F.col("event_name") == ev, F.col("event_timestamp"))).alias(n) for n, ev in (
            ("results_at", "view_search_results"), ("detail_at", "view_item"),
            ("inspection_at", "view_inspection_report"), ("booking_at", "booking_complete"))])
    d = (sessions.select("session_id", "device_category", "is_returning_user")
         .join(first_at, "session_id", "left")
         .select("device_category", "is_returning_user",
                 seconds_between(F.col("results_at"), F.col("detail_at")).alias("r2d"),
                 seconds_between(F.col("detail_at"), F.col("inspection_at")).alias("d2i"),
                 seconds_between(F.col("detail_at"), F.col("booking_at")).alias("d2b")))
    g = d.groupBy("device_category", "is_returning_user").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count("r2d").alias("detail_transitions"),
        F.percentile("r2d", 0.5).alias("m_r2d"),
        F.percentile("r2d", 0.9).alias("p90_r2d"),
        F.percentile("d2i", 0.5).alias("m_d2i"),
        F.percentile("d2b", 0.5).alias("m_d2b"))
    return g.select(
        "device_category", "is_returning_user",
        F.col("sessions").cast("long").alias("sessions"),
        F.col("detail_transitions").cast("long").alias("detail_transitions"),
        dround("m_r2d", 1).alias("median_results_to_detail_seconds"),
        dround("p90_r2d", 1).alias("p90_results_to_detail_seconds"),
        dround("m_d2i", 1).alias("median_detail_to_inspection_seconds"),
        dround("m_d2b", 1).alias("median_detail_to_booking_seconds"))


# -------------------------------------------------------------------------- K11
AGING_BUCKETS = ((15, "0-15"), (30, "16-30"), (45, "31-45"), (60, "46-60"), (90, "61-90"))


def aging_bucket(days: F.Column) -> F.Column:
    expr = None
    for upper, label in AGING_BUCKETS:
        expr = F.when(days <= upper, label) if expr is None else expr.when(days <= upper, label)
    return expr.otherwise("90+")


def inventory_aging(cars: DataFrame) -> DataFrame:
    """Age buckets x city x body: count, median age, sell-through, median price."""
    by = ["aging_bucket", "city", "body_type"]
    cars = cars.withColumn("aging_bucket", aging_bucket(F.col("days_in_inventory")))
    # A median's state is one entry per distinct value: few for days, unbounded for prices.
    g = cars.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_cars"),
        F.median("days_in_inventory").alias("median_days"),
        F.avg(flag(F.col("sold_flag"))).alias("sell_through"))
    g = join_quantiles(g, cars, by, "listed_price", {"median_price": 0.5})
    return g.select("aging_bucket", "city", "body_type",
                    F.col("n_cars").cast("long").alias("n_cars"),
                    dround("median_days", 1).alias("median_days_in_inventory"),
                    dround("sell_through", 4).alias("sell_through_rate"),
                    dround("median_price", 0).alias("median_listed_price"))


# -------------------------------------------------------------------------- K12
def inventory_survival(cars: DataFrame, max_day: int = 180, step: int = 15) -> DataFrame:
    """Life-table hazard and survival per body type over 15-day intervals.

    Cars are first collapsed to (body_type, days, sold) counts, then crossed with
    the 13 interval starts via ``explode(sequence)`` - the grid is a constant, so
    the cross product is bounded by 13x the number of distinct (body, days)."""
    per_age = cars.groupBy("body_type", "days_in_inventory").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("sold_flag"), 1)).alias("n_sold"))
    grid = per_age.withColumn("interval_start", F.explode(F.sequence(F.lit(0), F.lit(max_day), F.lit(step))))
    d, i = F.col("days_in_inventory"), F.col("interval_start")
    risk = grid.groupBy("body_type", "interval_start").agg(
        F.sum(F.when(d >= i, F.col("n")).otherwise(0)).alias("at_risk"),
        F.sum(F.when((d >= i) & (d < i + step), F.col("n_sold")).otherwise(0)).alias("sold_in_interval"))
    hazards = (risk.filter(F.col("at_risk") > 0)
               .withColumn("interval_hazard", F.col("sold_in_interval") / F.col("at_risk")))
    w = (Window.partitionBy("body_type").orderBy("interval_start")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    log_surv = F.sum(F.log(F.greatest(F.lit(1.0) - F.col("interval_hazard"), F.lit(1e-6)))).over(w)
    return hazards.select(
        "body_type", F.col("interval_start").cast("long").alias("interval_start"),
        F.col("at_risk").cast("long").alias("at_risk"),
        F.col("sold_in_interval").cast("long").alias("sold_in_interval"),
        dround("interval_hazard", 4).alias("interval_hazard"),
        dround(F.exp(log_surv), 4).alias("survival_probability"))


# -------------------------------------------------------------------------- K13
def position_bias(impressions: DataFrame) -> DataFrame:
    """CTR and empirical examination rate by list position."""
    g = impressions.groupBy("list_position").agg(
        F.count(F.lit(1)).alias("impressions"),
        F.sum(flag(F.col("clicked"))).alias("clicks"),
        F.avg(flag(F.col("clicked")).cast("double")).alias("ctr"),
        F.avg(flag(F.col("examined")).cast("double")).alias("exam"))
    return g.select("list_position", F.col("impressions").cast("long").alias("impressions"),
                    F.col("clicks").cast("long").alias("clicks"),
                    dround("ctr", 4).alias("ctr"),
                    dround("exam", 4).alias("empirical_examination_rate"))


# -------------------------------------------------------------------------- K14
def price_analysis(cars: DataFrame, min_listings: int = 3, limit: int = 200) -> DataFrame:
    """Listed vs realised price and discount by make x model x body x city."""
    by = ["make", "model", "body_type", "city"]
    g = cars.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_listings"),
        F.avg(F.try_divide(F.col("listed_price") - F.col("transaction_price"), F.col("listed_price")))
        .alias("disc"),
        F.avg(flag(F.col("sold_flag"))).alias("st"))
    for name, price in (("ml", "listed_price"), ("mt", "transaction_price")):
        g = join_quantiles(g, cars, by, price, {name: 0.5})
    out = g.filter(F.col("n_listings") >= min_listings).select(
        "make", "model", "body_type", "city", F.col("n_listings").cast("long").alias("n_listings"),
        dround("ml", 0).alias("median_listed_price"),
        dround("mt", 0).alias("median_transaction_price"),
        dround("disc", 4).alias("avg_discount"),
        dround("st", 4).alias("sell_through"))
    return out.orderBy(F.col("n_listings").desc(), "make", "model", "body_type", "city").limit(limit)


# -------------------------------------------------------------------------- K15
def sql_propensity(position: F.Column) -> F.Column:
    expr = None
    for i, p in enumerate(SQL_POSITION_PROPENSITY, start=1):
        expr = F.when(position == i, F.lit(p)) if expr is None else expr.when(position == i, F.lit(p))
    return expr.otherwise(F.lit(SQL_POSITION_PROPENSITY_DEFAULT))


def recommendation_ips(impressions: DataFrame, cars: DataFrame) -> DataFrame:
    """Naive vs inverse-propensity-weighted CTR and booking rate by body type.

    Impressions are pre-aggregated to integer counts per (car, position) - exact,
    and a hot car collapses map-side - before the car join."""
    per_pos = impressions.groupBy("car_id", "list_position").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("clicked").alias("n_click_known"),
        F.sum(flag(F.col("clicked"))).alias("clicks"),
        F.sum(flag(F.col("booked"))).alias("books"))
    p = sql_propensity(F.col("list_position"))
    j = per_pos.join(cars.select("car_id", "body_type"), "car_id", "inner").withColumn("p", p)
    g = j.groupBy("body_type").agg(
        F.sum("n").alias("impressions"), F.sum("clicks").alias("clicks"),
        F.sum("n_click_known").alias("n_click_known"),
        F.sum(F.col("clicks") / F.col("p")).alias("w_clicks"),
        F.sum(F.col("books") / F.col("p")).alias("w_books"),
        F.sum(F.col("n") / F.col("p")).alias("w"),
        F.sum(F.col("n") * F.col("p")).alias("sum_p"))
    return g.select(
        "body_type", F.col("impressions").cast("long").alias("impressions"),
        dround(safe_div(F.col("clicks"), F.col("n_click_known")), 4).alias("naive_ctr"),
        dround(safe_div(F.col("w_clicks"), F.col("w")), 4).alias("ips_ctr"),
        dround(safe_div(F.col("w_books"), F.col("w")), 4).alias("ips_booking_rate"),
        dround(F.col("sum_p") / F.col("impressions"), 4).alias("average_examination_propensity"))


# -------------------------------------------------------------------------- K16
def relevance_label(df: DataFrame | None = None) -> F.Column:
    """Graded relevance 0-10 from impression outcome flags."""
    c = F.col
    return (F.when(c("purchased"), 10).when(c("booked"), 9).when(c("callback"), 7)
            .when(c("wishlisted"), 6).when(c("emi_calculated"), 5)
            .when(c("viewed_inspection"), 4).when(c("compared"), 4)
            .when(c("viewed_gallery"), 3).when(c("clicked"), 2).otherwise(0))


def recommendation_metrics(impressions: DataFrame) -> DataFrame:
    """Per-impression graded relevance and clipped propensity weight."""
    return impressions.select(
        "session_id", "user_id", "car_id", F.col("list_position").alias("rank_position"),
        relevance_label().cast("int").alias("relevance_label"),
        "clicked", "wishlisted", "booked", "purchased",
        dround(F.lit(1.0) / F.greatest(sql_propensity(F.col("list_position")), F.lit(0.1)), 3)
        .alias("propensity_weight"))


# -------------------------------------------------------------------------- K17
def user_intent_analysis(events: DataFrame, cars: DataFrame) -> DataFrame:
    """First viewed body type vs booked body type within a session."""
    c = cars.select("car_id", "make", "body_type")
    firsts = (events.filter(F.col("event_name") == "view_item")
              .join(c, "car_id", "inner")
              .groupBy("session_id")
              .agg(F.min_by(F.struct("make", "body_type"),
                            F.struct("event_timestamp", "event_id")).alias("f"))
              .select("session_id", F.col("f.body_type").alias("first_viewed_body")))
    booked = (events.filter(F.col("event_name") == "booking_complete")
              .join(c, "car_id", "inner")
              .select("session_id", F.col("body_type").alias("booked_body")))
    return (firsts.join(booked, "session_id", "inner")
            .groupBy("first_viewed_body", "booked_body")
            .agg(F.count(F.lit(1)).cast("long").alias("n_sessions")))
