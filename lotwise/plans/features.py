"""Leak-free point-in-time feature datasets.

* price: one row per sold car, observed at listing (entry) time;
* booking: one row per impression; user history strictly before the session,
  session counters up to the session's first impression (decision time);
* sell-through: inventory snapshots at ages 0/7/14/30/45 days with engagement
  counters up to the snapshot.

Market context comes from ``lotwise.operators.pit`` (timeline running sums).
Per-user running counts use the same bucketed running-sum operator, so one
heavy user does not serialise a window.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.functions import clip_lower, epoch_seconds
from lotwise.operators.pit import attach_market_context
from lotwise.operators.scan import segmented_sums
from lotwise.session import checkpoint_dir

PRICE_FEATURES = [
    "make", "model", "variant", "body_type", "fuel_type", "transmission",
    "manufacturing_year", "registration_year", "vehicle_age", "kilometres_driven",
    "kilometres_per_year", "owner_count", "city", "state", "engine_cc",
    "claimed_mileage_kmpl", "insurance_valid", "service_history_available",
    "accident_history", "inspection_score", "exterior_score", "interior_score",
    "engine_score", "tyre_score", "number_of_features", "inventory_entry_month",
    "market_demand_index", "local_supply_index", "model_popularity",
]
PRICE_CAT = ["make", "model", "variant", "body_type", "fuel_type", "transmission", "city", "state"]

BOOKING_FEATURES = [
    "prior_sessions", "prior_booking_rate", "is_returning_user",
    "purchase_urgency", "price_sensitivity", "quality_sensitivity",
    "finance_interest", "brand_loyalty", "first_time_buyer_probability",
    "session_duration_s", "session_searches", "session_filters",
    "session_events", "session_sequence_number", "device_category",
    "source", "medium", "campaign_id",
    "price_budget_gap", "emi_budget_gap", "brand_match", "body_match",
    "fuel_match", "trans_match", "city_match", "age_over_tolerance",
    "km_over_tolerance", "hard_violations",
    "listed_price", "inspection_score", "vehicle_age", "kilometres_driven",
    "market_demand_index", "local_supply_index", "finance_available",
    "delivery_available", "model_popularity", "body_type", "fuel_type",
    "transmission", "make", "city",
    "list_position",
]
BOOKING_CAT = ["body_type", "fuel_type", "transmission", "make", "device_category",
               "source", "medium", "campaign_id", "city"]

SELL_FEATURES = [
    "snapshot_age", "listed_price", "vehicle_age", "kilometres_driven",
    "owner_count", "inspection_score", "number_of_features",
    "views", "clicks", "inspection_views", "wishlists", "bookings_cnt",
    "click_rate", "booking_rate", "market_demand_index", "local_supply_index",
    "comparable_inventory", "finance_available", "delivery_available",
    "model_popularity", "make", "model", "body_type", "fuel_type",
    "transmission", "city",
]
SELL_CAT = ["make", "model", "body_type", "fuel_type", "transmission", "city"]
#: Columns that the booking data set is made of.
BOOKING_INPUTS = {
    *BOOKING_FEATURES, "session_id", "user_id", "car_id", "event_timestamp", "clicked", "examined", "booked",
    "session_start", "maximum_budget", "maximum_emi", "preferred_makes", "preferred_body_types",
    "preferred_fuel_types", "preferred_transmissions", "home_city", "vehicle_age_tolerance", "kilometre_tolerance",
} - {"market_demand_index", "local_supply_index"}

SNAPSHOT_AGES = (0, 7, 14, 30, 45)
SELL_COUNTERS = (("view_item", "views"), ("select_item", "clicks"),
                 ("view_inspection_report", "inspection_views"),
                 ("add_to_wishlist", "wishlists"), ("book_test_drive", "bookings_cnt"))


# ---------------------------------------------------------------------------- O1
def car_base_features(cars: DataFrame, with_static_supply: bool = True) -> DataFrame:
    """Vehicle age at entry, km per year, entry month and (optionally) the static
    local supply index = segment share of its city's inventory."""
    age = clip_lower(F.year("inventory_entry_date") - F.col("manufacturing_year"), 0)
    df = (cars.withColumn("vehicle_age", age.cast("int"))
              .withColumn("kilometres_per_year",
                          F.col("kilometres_driven") / clip_lower(F.col("vehicle_age"), 1))
              .withColumn("inventory_entry_month", F.month("inventory_entry_date")))
    if not with_static_supply:
        return df
    seg = (cars.filter(F.col("city").isNotNull() & F.col("body_type").isNotNull())
           .groupBy("city", "body_type").agg(F.count(F.lit(1)).alias("segment_supply")))
    city = seg.groupBy("city").agg(F.sum("segment_supply").alias("city_supply"))
    seg = seg.join(city, "city").select(
        "city", "body_type", (F.col("segment_supply") / F.col("city_supply")).alias("local_supply_index"))
    return df.join(seg, ["city", "body_type"], "left")


# ---------------------------------------------------------------------------- O3
def attach_demand_index(cars_f: DataFrame, events: DataFrame) -> DataFrame:
    """Static demand index: view_item events per (event city, car body) over the
    mean per segment; 0.5 where a segment has no views."""
    ev = (events.filter((F.col("event_name") == "view_item") & F.col("car_id").isNotNull())
          .join(cars_f.select("car_id", "body_type"), "car_id", "left"))
    dem = (ev.filter(F.col("city").isNotNull() & F.col("body_type").isNotNull())
           .groupBy("city", "body_type").agg(F.count(F.lit(1)).alias("demand_events")))
    mean = dem.agg(F.avg("demand_events").alias("__mean"))
    dem = dem.crossJoin(F.broadcast(mean)).select(
        "city", "body_type", (F.col("demand_events") / F.col("__mean")).alias("market_demand_index"))
    out = cars_f.drop("market_demand_index").join(dem, ["city", "body_type"], "left")
    return out.fillna({"market_demand_index": 0.5})


# ---------------------------------------------------------------------------- O4
def build_price_dataset(cars: DataFrame, events: DataFrame) -> DataFrame:
    f = car_base_features(cars, with_static_supply=False) \
        .withColumn("observation_date", F.col("inventory_entry_date").cast("timestamp_ntz"))
    f = attach_market_context(f, cars, events, "observation_date")
    ds = f.filter(F.col("sold_flag")).withColumn("target_price", F.col("transaction_price"))
    return ds.select("car_id", "observation_date", "target_price", "listed_price", *PRICE_FEATURES)


# ---------------------------------------------------------------------------- O5
def build_booking_dataset(impressions: DataFrame, sessions: DataFrame, users: DataFrame,
                          cars: DataFrame, events: DataFrame) -> DataFrame:
    """Impression-grain booking dataset.

    Column provenance follows the reference's merge order: session attributes
    (incl. ``city`` = session city) first, then user, then car attributes
    (the car's city becomes ``city_car``)."""
    cars_f = car_base_features(cars, with_static_supply=False).drop(
        "sold_flag", "transaction_price", "inventory_exit_date", "days_in_inventory", "acquisition_price")
    s_cols = [c for c in sessions.columns if c not in ("session_id", "user_id")]
    sess = sessions.select("session_id", "user_id",
                           *[F.col(c).alias(c + "_s" if c in impressions.columns else c) for c in s_cols])
    cols = [*impressions.columns, *[c for c in sess.columns if c not in ("session_id", "user_id")],
            *[c for c in users.columns if c != "user_id"]]
    car = cars_f.select("car_id", *[F.col(c).alias(c + "_car" if c in cols else c)
                                    for c in cars_f.columns if c != "car_id"])
    # What the output needs, each column once: rows are shuffled with no others.
    imp, sess, user, car = (df.select(*[c for c in df.columns if c in BOOKING_INPUTS])
                            for df in (impressions, sess, users, car))
    imp = imp.withColumn("observation_date", F.col("event_timestamp").cast("timestamp_ntz")).drop("event_timestamp")

    # Everything of a session is found in a row for each session and joined to the impressions once.  Its
    # attributes feed history, decision time, market context and output: they are stored.
    checkpoint_dir(imp.sparkSession)
    per = (imp.groupBy("session_id", "user_id").agg(F.max(F.col("booked").cast("int")).alias("__booked"),
                                                    F.min("observation_date").alias("__first"))
           .join(sess, ["session_id", "user_id"], "left").checkpoint(eager=True))

    # Prior sessions / bookings strictly before this session (sessions that had
    # impressions), as running totals per user over (session_start, sequence).
    sess_book = (per.filter(F.col("user_id").isNotNull() & F.col("session_sequence_number").isNotNull()
                            & F.col("session_start").isNotNull())
                 .groupBy("user_id", "session_sequence_number", "session_start")
                 .agg(F.max("__booked").alias("b")).withColumn("one", F.lit(1)))
    hist = segmented_sums(sess_book, ["user_id"], ["session_start", "session_sequence_number"], ["one", "b"])
    hist = hist.select("user_id", "session_sequence_number",
                       (F.col("run_one") - 1).cast("long").alias("prior_sessions"),
                       (F.col("run_b") - F.col("b")).cast("long").alias("prior_bookings"))

    # Session counters up to the decision time (first impression of the session).
    decision = per.groupBy("session_id").agg(F.min("__first").alias("decision_time"))
    pre = (events.select("session_id", "event_id", "event_name", "event_timestamp")
           .join(decision, "session_id", "inner")
           .filter(F.col("event_timestamp") <= F.col("decision_time"))
           .groupBy("session_id")
           .agg(F.count_if(F.col("event_name") == "search").alias("session_searches"),
                F.count_if(F.col("event_name") == "apply_filter").alias("session_filters"),
                F.count("event_id").alias("session_events")))
    of_session = (per.drop("__booked", "__first").join(user, "user_id", "left")
                  .join(hist, ["user_id", "session_sequence_number"], "left").join(pre, "session_id", "left")
                  .withColumn("prior_booking_rate",
                              F.col("prior_bookings") / F.greatest(F.col("prior_sessions"), F.lit(1))))

    def with_session(rows: DataFrame, session: DataFrame) -> DataFrame:
        s = session.withColumnsRenamed({"session_id": "__session", "user_id": "__user"})
        return rows.join(s, rows["session_id"].eqNullSafe(s["__session"]) & rows["user_id"].eqNullSafe(s["__user"]),
                         "left").drop("__session", "__user")

    context_keys = with_session(imp.select("session_id", "user_id", "car_id", "observation_date").join(
        car.select("car_id", "body_type"), "car_id", "left"), per.select("session_id", "user_id", "city").distinct())
    imp = with_session(imp.join(car, "car_id", "left"), of_session)
    imp = attach_market_context(imp, cars, events, "observation_date", context_keys)
    imp = imp.withColumn("session_duration_s",
                         epoch_seconds(F.col("observation_date")) - epoch_seconds(F.col("session_start")))

    c = F.col
    imp = (imp.withColumn("price_budget_gap", (c("listed_price") - c("maximum_budget")) / c("maximum_budget"))
              .withColumn("emi_budget_gap", (c("listed_price") / 60.0 - c("maximum_emi")) / c("maximum_emi"))
              .withColumn("brand_match", F.coalesce((c("make") == c("preferred_makes")).cast("int"), F.lit(0)))
              .withColumn("body_match", F.coalesce((c("body_type") == c("preferred_body_types")).cast("int"), F.lit(0)))
              .withColumn("fuel_match", F.coalesce((c("fuel_type") == c("preferred_fuel_types")).cast("int"), F.lit(0)))
              .withColumn("trans_match", F.coalesce((c("transmission") == c("preferred_transmissions")).cast("int"), F.lit(0)))
              .withColumn("city_match", F.coalesce((c("city") == c("home_city")).cast("int"), F.lit(0)))
              .withColumn("age_over_tolerance", clip_lower(c("vehicle_age") - c("vehicle_age_tolerance"), 0.0))
              .withColumn("km_over_tolerance",
                          clip_lower(c("kilometres_driven") - c("kilometre_tolerance"), 0.0) / 10000.0)
              .withColumn("hard_violations",
                          F.coalesce((c("price_budget_gap") > 0.10).cast("int"), F.lit(0))
                          + F.coalesce((c("age_over_tolerance") > 2).cast("int"), F.lit(0)))
              .withColumn("label_booked", F.coalesce(c("booked").cast("int"), F.lit(0))))
    keep = ["session_id", "user_id", "car_id", "observation_date", "label_booked", "clicked", "examined"]
    return imp.select(*keep, *BOOKING_FEATURES)


# ---------------------------------------------------------------------------- O6
def build_sellthrough_dataset(cars: DataFrame, events: DataFrame,
                              ages: tuple[int, ...] = SNAPSHOT_AGES) -> DataFrame:
    """Snapshots while the car is still in stock (days_in_inventory >= age).

    Engagement counters count events with timestamp <= snapshot midnight: events
    are first collapsed to (car, day-ceiling) counts, so a hot car contributes
    at most one row per day to the snapshot join."""
    cars_f = car_base_features(cars, with_static_supply=False)
    snaps = (cars_f.withColumn("snapshot_age", F.explode(F.array(*[F.lit(a) for a in ages])))
             .filter(F.col("days_in_inventory") >= F.col("snapshot_age"))
             .withColumn("snapshot_date",
                         F.date_add("inventory_entry_date", F.col("snapshot_age")).cast("timestamp_ntz"))
             .withColumn("label_sold_30d",
                         (F.col("sold_flag") & (F.col("days_in_inventory") <= F.col("snapshot_age") + 30))
                         .cast("int")))
    checkpoint_dir(snaps.sparkSession)
    # What the output needs: snapshots are several times the cars, shuffled and stored.
    snaps = snaps.select(*[c for c in snaps.columns if c in (*SELL_FEATURES, "car_id", "snapshot_date",
                                                              "label_sold_30d")])
    snaps = attach_market_context(snaps, cars, events, "snapshot_date").checkpoint(eager=True)

    ts = F.col("event_timestamp")
    day_ceiling = F.when(ts == F.to_date(ts).cast("timestamp_ntz"), F.to_date(ts)) \
        .otherwise(F.date_add(F.to_date(ts), 1))
    names = [n for n, _ in SELL_COUNTERS]
    daily = (events.filter(F.col("car_id").isNotNull() & F.col("event_name").isin(*names))
             .groupBy("car_id", day_ceiling.cast("timestamp_ntz").alias("day"))
             .agg(*[F.count_if(F.col("event_name") == n).alias(col) for n, col in SELL_COUNTERS]))
    keys = snaps.select("car_id", "snapshot_date").distinct()
    counts = (keys.join(daily, "car_id", "inner")
              .filter(F.col("day") <= F.col("snapshot_date"))
              .groupBy("car_id", "snapshot_date")
              .agg(*[F.sum(col).alias(col) for _, col in SELL_COUNTERS]))
    ds = snaps.join(counts, ["car_id", "snapshot_date"], "left")
    for _, col in SELL_COUNTERS:
        ds = ds.withColumn(col, F.coalesce(F.col(col), F.lit(0)).cast("long"))
    ds = (ds.withColumn("click_rate", F.col("clicks") / F.greatest(F.col("views"), F.lit(1)))
            .withColumn("booking_rate", F.col("bookings_cnt") / F.greatest(F.col("clicks"), F.lit(1))))
    comp = (ds.filter(F.col("city").isNotNull() & F.col("body_type").isNotNull())
            .groupBy("city", "body_type", "snapshot_age").agg(F.count(F.lit(1)).alias("comparable_inventory")))
    ds = ds.join(comp, ["city", "body_type", "snapshot_age"], "left")
    ds = ds.withColumn("observation_date", F.col("snapshot_date"))
    return ds.select("car_id", "observation_date", "label_sold_30d", *SELL_FEATURES)


# ---------------------------------------------------------------------------- O7
def build_all(tables: dict[str, DataFrame], out_dir: str | None = None) -> dict[str, DataFrame]:
    """The three model datasets; written as Parquet when ``out_dir`` is given."""
    t = tables
    out = dict(price=build_price_dataset(t["cars"], t["events"]),
               booking=build_booking_dataset(t["impressions"], t["sessions"], t["users"],
                                             t["cars"], t["events"]),
               sellthrough=build_sellthrough_dataset(t["cars"], t["events"]))
    if out_dir:
        for name, df in out.items():
            df.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/{name}_dataset")
    return out
