"""Deterministic mapping of the driver's TPC-H-like tables onto the canonical
marketplace contract (users, cars, campaigns, sessions, events, impressions).

Pure column expressions plus one aggregation (sessions) and one join
(impressions = lineitem x orders); nothing is collected.  The same mapping is
written as DuckDB CTEs in ``lotwise.plans.oracle`` for the correctness gate.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.contracts import BODY_TYPES
from lotwise.operators.ranks import group_row_number
from lotwise.sources.io import conform

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")

# Fixed mapping values (shared with the oracle CTEs).
FUEL_TYPES = ("Petrol", "Diesel", "CNG")
CHANNELS = ("Search", "Display", "Email", "Direct")
SOURCES = (("google", "cpc"), ("facebook", "paid_social"), ("(direct)", "(none)"), ("newsletter", "email"))
AGE_BANDS = ("18-25", "26-35", "36-45", "46+")
# part.p_type -> body type: a model has one body type.
TYPE_TO_BODY = (("ECONOMY", "Hatchback"), ("SMALL", "Hatchback"), ("STANDARD", "Sedan"),
                ("MEDIUM", "Compact SUV"), ("LARGE", "SUV"), ("PROMO", "MPV"))
N_CAR_CITIES = 5          # cars sit in NATION_0..NATION_4


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def key_count(spark: SparkSession, sf_dir: str, name: str) -> Column:
    """Rows of a table whose keys run from 0: the modulus that maps any number to one of
    its keys, as a scalar subquery."""
    return driver_table(spark, sf_dir, name).agg(F.count(F.lit(1))).scalar()


def _pick(values: tuple[str, ...], index: Column) -> Column:
    """values[index] for a 0-based integer index column (a CASE, codegen'd)."""
    expr = None
    for i, v in enumerate(values):
        expr = (F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v)))
    return expr


def _sid(c: Column) -> Column:
    return c.cast("string")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = driver_table(spark, sf_dir, "customer")
    n = driver_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    max_budget = (F.lit(800000) + (k * 37 % 1300) * 1000).cast("double")
    df = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left").select(
        _sid(k).alias("user_id"),
        F.date_add(F.lit("2023-10-01").cast("date"), (k % 90).cast("int")).alias("signup_date"),
        F.col("n_name").alias("home_city"),
        _pick(AGE_BANDS, k % 4).alias("age_band"),
        F.col("c_mktsegment").alias("income_band"),
        F.concat(F.lit("size_"), (k % 3 + 1).cast("string")).alias("family_size_band"),
        ((k % 10).cast("double") / 10.0).alias("first_time_buyer_probability"),
        _pick(BODY_TYPES, k % 5).alias("preferred_body_types"),
        F.concat(F.lit("Brand#"), (k % 25 + 1).cast("string")).alias("preferred_makes"),
        _pick(FUEL_TYPES, k % 3).alias("preferred_fuel_types"),
        F.when(k % 2 == 0, "Automatic").otherwise("Manual").alias("preferred_transmissions"),
        (max_budget * 0.8).alias("ideal_budget"),
        max_budget.alias("maximum_budget"),
        (max_budget / 60.0).alias("ideal_emi"),
        (max_budget / 48.0).alias("maximum_emi"),
        (k % 10 + 3).cast("double").alias("vehicle_age_tolerance"),
        ((k % 10 + 3) * 15000).cast("double").alias("kilometre_tolerance"),
        ((k % 7).cast("double") / 7.0).alias("quality_sensitivity"),
        ((k % 11).cast("double") / 11.0).alias("price_sensitivity"),
        ((k % 13).cast("double") / 13.0).alias("brand_loyalty"),
        ((k % 17).cast("double") / 17.0).alias("exploration_tendency"),
        ((k % 19).cast("double") / 19.0).alias("finance_interest"),
        ((k % 23).cast("double") / 23.0).alias("purchase_urgency"),
    )
    return conform(df, "users")


def cars(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = driver_table(spark, sf_dir, "part")
    n = driver_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    k, size = F.col("p_partkey"), F.col("p_size")
    listed = F.col("p_retailprice") * 1000.0
    sold = (k % 5) < 3
    entry = F.date_add(F.lit("2023-11-01").cast("date"), (k % 75).cast("int"))
    days = (size * 4).cast("int")
    mfg = (F.lit(2010) + size % 14).cast("int")
    inspection = (F.lit(50) + size).cast("double")
    body = None
    for ptype, b in TYPE_TO_BODY:
        cond = F.col("p_type") == ptype
        body = F.when(cond, b) if body is None else body.when(cond, b)
    df = p.join(F.broadcast(n), (p.p_partkey % N_CAR_CITIES) == n.n_nationkey, "left").select(
        _sid(k).alias("car_id"),
        F.col("p_brand").alias("make"),
        F.col("p_type").alias("model"),
        F.col("p_name").alias("variant"),
        body.alias("body_type"),
        _pick(FUEL_TYPES, k % 3).alias("fuel_type"),
        F.when(size % 3 == 0, "Automatic").otherwise("Manual").alias("transmission"),
        mfg.alias("manufacturing_year"),
        (mfg + (k % 2).cast("int")).alias("registration_year"),
        (size * 1500 + (k % 1000) * 10).cast("double").alias("kilometres_driven"),
        (k % 3 + 1).cast("int").alias("owner_count"),
        F.col("n_name").alias("city"),
        F.concat(F.lit("STATE_"), F.col("n_regionkey").cast("string")).alias("state"),
        (F.lit(1000) + size * 20).cast("double").alias("engine_cc"),
        (F.lit(12) + size % 10).cast("double").alias("claimed_mileage_kmpl"),
        (k % 4 != 0).alias("insurance_valid"),
        (k % 3 != 0).alias("service_history_available"),
        (k % 11 == 0).alias("accident_history"),
        inspection.alias("inspection_score"),
        inspection.alias("exterior_score"),
        (inspection - 1.0).alias("interior_score"),
        (inspection - 2.0).alias("engine_score"),
        (inspection - 3.0).alias("tyre_score"),
        (size % 20 + 5).cast("int").alias("number_of_features"),
        (listed * 0.85).alias("acquisition_price"),
        listed.alias("listed_price"),
        entry.alias("inventory_entry_date"),
        F.when(sold, F.date_add(entry, days)).alias("inventory_exit_date"),
        sold.alias("sold_flag"),
        F.when(sold, listed * ((F.lit(93) + k % 8).cast("double") / 100.0)).alias("transaction_price"),
        days.alias("days_in_inventory"),
        (k % 2 == 0).alias("delivery_available"),
        (k % 3 != 1).alias("finance_available"),
        ((size % 10).cast("double") / 10.0).alias("model_popularity"),
    )
    return conform(df, "cars")


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = driver_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    src = k % 4
    df = s.select(
        _sid(k).alias("campaign_id"),
        F.col("s_name").alias("campaign_name"),
        _pick(tuple(x[0] for x in SOURCES), src).alias("source"),
        _pick(tuple(x[1] for x in SOURCES), src).alias("medium"),
        _pick(CHANNELS, k % 4).alias("channel"),
        F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")).alias("target_city"),
        _pick(BODY_TYPES, k % 5).alias("target_segment"),
        F.lit("2024-01-01").cast("date").alias("start_date"),
        F.lit("2024-01-30").cast("date").alias("end_date"),
        (F.lit(3000) + k * 100).cast("double").alias("daily_budget"),
        (F.lit(5) + (k % 5) * 4).cast("double").alias("cost_per_click"),
        F.lit(1.0).alias("quality_multiplier"),
        F.lit(1.0).alias("intent_multiplier"),
        F.lit(1.0).alias("inventory_match_multiplier"),
    )
    return conform(df, "campaigns")


def _event_name(etype: Column, eid: Column) -> Column:
    return (
        F.when(etype == "view", _pick(("view_search_results", "view_item", "view_gallery"), eid % 3))
        .when(etype == "click", _pick(("select_item", "view_inspection_report", "calculate_emi",
                                       "add_to_wishlist"), eid % 4))
        .when(etype == "signup", _pick(("apply_filter", "request_callback", "book_test_drive"), eid % 3))
        .when(etype == "purchase", F.when(eid % 4 == 0, "purchase").otherwise("booking_complete"))
        .when(etype == "error", F.when(eid % 2 == 0, "search").otherwise("view_item"))
        .otherwise("view_home")
    )


def _carries_car(etype: Column, eid: Column) -> Column:
    return (etype.isin("click", "purchase")
            | ((etype == "view") & (eid % 3 > 0))
            | ((etype == "signup") & (eid % 3 > 0))
            | ((etype == "error") & (eid % 2 == 1)))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = driver_table(spark, sf_dir, "events")
    n = driver_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    eid, uid, etype = F.col("event_id"), F.col("user_id"), F.col("event_type")
    doy = F.dayofyear("ts")
    name = _event_name(etype, eid)
    is_filter = name == "apply_filter"
    fdim = eid % 4
    filter_name = F.when(is_filter, _pick(("body_type", "transmission", "max_price", "fuel_type"), fdim))
    filter_value = F.when(is_filter, (
        F.when(fdim == 0, _pick(BODY_TYPES, eid % 5))
        .when(fdim == 1, F.when(eid % 5 < 2, "Automatic").otherwise("Manual"))
        .when(fdim == 2, (F.lit(800000) + (eid % 13) * 100000).cast("string"))
        .otherwise(_pick(FUEL_TYPES, eid % 7 % 3))))
    listed = name.isin("view_search_results", "select_item")
    src = uid % 4
    df = e.join(F.broadcast(n), (e.user_id % 25) == n.n_nationkey, "left").select(
        _sid(eid).alias("event_id"),
        F.col("ts").alias("event_timestamp"),
        F.to_date("ts").alias("event_date"),
        _sid(uid).alias("user_id"),
        _sid(uid * 1000 + doy).alias("session_id"),
        name.alias("event_name"),
        F.when(_carries_car(etype, eid), _sid(eid * 7919 % key_count(spark, sf_dir, "part"))).alias("car_id"),
        F.when(listed, F.lit("search_results")).alias("item_list_id"),
        F.when(listed, (eid % 10 + 1).cast("int")).alias("list_position"),
        F.when(name == "search", F.lower(_pick(BODY_TYPES, eid % 5))).alias("search_term"),
        filter_name.alias("filter_name"),
        filter_value.alias("filter_value"),
        F.col("value").alias("engagement_time_seconds"),
        F.concat(F.lit("/"), name).alias("page_location"),
        _pick(tuple(x[0] for x in SOURCES), src).alias("source"),
        _pick(tuple(x[1] for x in SOURCES), src).alias("medium"),
        _sid((uid + doy) % key_count(spark, sf_dir, "supplier")).alias("campaign_id"),
        _pick(("mobile", "desktop", "tablet"), uid % 3).alias("device_category"),
        F.col("n_name").alias("city"),
    )
    return conform(df, "events")


def sessions_from_events(ev: DataFrame) -> DataFrame:
    """One row per session: bounds, (constant) attributes, per-user sequence.

    The per-user sequence uses ``group_row_number`` (range-partitioned), so a
    user holding a large share of all sessions is still split across tasks."""
    s = ev.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        F.min("campaign_id").alias("campaign_id"),
        F.min("source").alias("source"),
        F.min("medium").alias("medium"),
        F.min("device_category").alias("device_category"),
        F.min("city").alias("city"),
    )
    s = group_row_number(s, ["user_id"], [F.col("session_start").asc_nulls_last(), F.col("session_id")],
                         "session_sequence_number")
    s = s.withColumn("is_returning_user", F.col("session_sequence_number") > 1)
    return conform(s, "sessions")


def impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = driver_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag")
    o = driver_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    q = F.col("l_quantity")
    df = li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        _sid(F.col("l_orderkey")).alias("session_id"),
        _sid(F.col("o_custkey")).alias("user_id"),
        _sid(F.col("l_partkey")).alias("car_id"),
        F.col("l_linenumber").cast("int").alias("list_position"),
        (q >= 10).alias("examined"),
        (q >= 25).alias("clicked"),
        (q >= 30).alias("viewed_gallery"),
        (q >= 33).alias("viewed_inspection"),
        (q >= 35).alias("compared"),
        (q >= 37).alias("emi_calculated"),
        (q >= 40).alias("wishlisted"),
        (q >= 42).alias("callback"),
        (q >= 45).alias("booked"),
        ((q >= 48) & (F.col("l_returnflag") == "R")).alias("purchased"),
        F.col("o_orderdate").alias("event_timestamp"),
        _sid(F.col("l_orderkey") % key_count(spark, sf_dir, "supplier")).alias("campaign_id"),
    )
    return conform(df, "impressions")


class Marketplace:
    """The six canonical tables.  Each is built on first access, so a query
    that never touches sessions never pays for sessionising the events."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir, self._cache = spark, sf_dir, {}

    def _get(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    @property
    def users(self) -> DataFrame:
        return self._get("users", lambda: users(self._spark, self._dir))

    @property
    def cars(self) -> DataFrame:
        return self._get("cars", lambda: cars(self._spark, self._dir))

    @property
    def campaigns(self) -> DataFrame:
        return self._get("campaigns", lambda: campaigns(self._spark, self._dir))

    @property
    def events(self) -> DataFrame:
        return self._get("events", lambda: events(self._spark, self._dir))

    @property
    def sessions(self) -> DataFrame:
        return self._get("sessions", lambda: sessions_from_events(self.events))

    @property
    def impressions(self) -> DataFrame:
        return self._get("impressions", lambda: impressions(self._spark, self._dir))

    def as_dict(self) -> dict[str, DataFrame]:
        return dict(users=self.users, cars=self.cars, campaigns=self.campaigns,
                    sessions=self.sessions, events=self.events, impressions=self.impressions)


def load_marketplace(spark: SparkSession, sf_dir: str) -> Marketplace:
    return Marketplace(spark, sf_dir)
