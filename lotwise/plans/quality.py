"""Warehouse checks (K18) and table contract validation (M1-M6).

Every check yields a violation *count*; a table's checks are computed in one
aggregation pass (``count_if`` over the rows, plus one join per foreign key)
and returned as a long DataFrame ``(table_name, check_name, violations)``.
Only ``validate_all`` collects, and what it collects is one row per check.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.contracts import BODY_TYPES, CANONICAL_EVENTS, FORBIDDEN_FEATURES
from lotwise.operators.ranks import group_row_number


class ValidationError(Exception):
    pass


def _violations(pred_ok: Column) -> Column:
    """Rows where the predicate is not TRUE (NULL counts as a violation, as a
    pandas comparison with NaN does)."""
    return F.count_if(~F.coalesce(pred_ok, F.lit(False)))


def _long(table: str, agg_row: DataFrame, names: list[str]) -> DataFrame:
    """One-row wide aggregate -> long (table, check, violations)."""
    stack = ", ".join(f"'{n}', `{n}`" for n in names)
    return agg_row.selectExpr(
        f"stack({len(names)}, {stack}) AS (check_name, violations)"
    ).select(F.lit(table).alias("table_name"), "check_name",
             F.col("violations").cast("long").alias("violations"))


def _duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of key values that occur more than once (one-row DataFrame)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .agg(F.count_if(F.col("n") > 1).alias("dups")))


# --------------------------------------------------------------------------- K18
def data_quality_checks(users: DataFrame, sessions: DataFrame, events: DataFrame,
                        cars: DataFrame, impressions: DataFrame) -> DataFrame:
    """The 8 warehouse checks; zero violations means the contracts hold."""
    s_users = sessions.select("user_id").join(users.select("user_id"), "user_id", "left_anti")
    orphan_user = s_users.agg(F.count(F.lit(1)).alias("v")) \
        .select(F.lit("orphan_session_user").alias("check_name"), "v")
    ev_s = events.select("session_id", "event_timestamp").join(
        sessions.select("session_id", "session_start", "session_end").withColumn("__hit", F.lit(True)),
        "session_id", "left")
    ev_checks = ev_s.agg(
        F.count_if(F.col("__hit").isNull()).alias("orphan_event_session"),
        F.count_if(F.col("event_timestamp") < F.col("session_start")).alias("event_before_session_start"),
        F.count_if(F.col("event_timestamp") > F.col("session_end") + F.expr("INTERVAL 1 SECOND"))
        .alias("event_after_session_end"))
    ev_checks = ev_checks.selectExpr(
        "stack(3, 'orphan_event_session', orphan_event_session, "
        "'event_before_session_start', event_before_session_start, "
        "'event_after_session_end', event_after_session_end) AS (check_name, v)")
    orphan_car = (events.filter(F.col("car_id").isNotNull()).select("car_id")
                  .join(cars.select("car_id"), "car_id", "left_anti")
                  .agg(F.count(F.lit(1)).alias("v"))
                  .select(F.lit("orphan_event_car").alias("check_name"), "v"))
    dup = _duplicate_keys(impressions, ["session_id", "car_id"]) \
        .select(F.lit("duplicate_impression_key").alias("check_name"), F.col("dups").alias("v"))
    imp = impressions.agg(F.count_if(F.col("purchased") & ~F.col("booked")).alias("v")) \
        .select(F.lit("purchase_without_booking").alias("check_name"), "v")
    sold = cars.agg(F.count_if(F.col("sold_flag") & F.col("transaction_price").isNull()).alias("v")) \
        .select(F.lit("sold_car_missing_transaction_price").alias("check_name"), "v")
    out = orphan_user
    for part in (ev_checks, orphan_car, dup, imp, sold):
        out = out.unionByName(part)
    return out.select("check_name", F.col("v").cast("long").alias("violations"))


# ---------------------------------------------------------------------------- M1
def validate_cars(cars: DataFrame) -> DataFrame:
    c = F.col
    sold = F.coalesce(c("sold_flag"), F.lit(False))
    checks = {
        "non-positive listed_price": c("listed_price") > 0,
        "non-positive acquisition_price": c("acquisition_price") > 0,
        "manufacturing_year out of range": c("manufacturing_year").between(2005, 2026),
        "registration_year before manufacturing_year": c("registration_year") >= c("manufacturing_year"),
        "negative kilometres": c("kilometres_driven") >= 0,
        "inspection_score out of [0,100]": c("inspection_score").between(0, 100),
        "sold car missing transaction_price": ~sold | c("transaction_price").isNotNull(),
        "unsold car has transaction_price": sold | c("transaction_price").isNull(),
        "unsold car has exit date": sold | c("inventory_exit_date").isNull(),
        "invalid body_type": c("body_type").isin(*BODY_TYPES),
        "owner_count out of range": c("owner_count").between(1, 6),
    }
    row = cars.agg(*[_violations(p).alias(n) for n, p in checks.items()])
    row = row.crossJoin(_duplicate_keys(cars, ["car_id"]).withColumnRenamed("dups", "car_id not unique"))
    return _long("cars", row, ["car_id not unique", *checks])


# ---------------------------------------------------------------------------- M2
USER_SHARES = ("first_time_buyer_probability", "quality_sensitivity", "price_sensitivity",
               "brand_loyalty", "exploration_tendency", "finance_interest", "purchase_urgency")


def validate_users(users: DataFrame) -> DataFrame:
    checks = {f"{col} outside [0,1]": F.col(col).between(0, 1) for col in USER_SHARES}
    checks["maximum_budget below ideal_budget"] = F.col("maximum_budget") >= F.col("ideal_budget")
    row = users.agg(*[_violations(p).alias(n) for n, p in checks.items()])
    row = row.crossJoin(_duplicate_keys(users, ["user_id"]).withColumnRenamed("dups", "user_id not unique"))
    return _long("users", row, ["user_id not unique", *checks])


# ---------------------------------------------------------------------------- M3
def validate_sessions_events(sessions: DataFrame, events: DataFrame, users: DataFrame,
                             cars: DataFrame, campaigns: DataFrame | None = None) -> DataFrame:
    c = F.col
    u = users.select("user_id", "signup_date").withColumn("__u", F.lit(True))
    s = group_row_number(sessions.join(u, "user_id", "left"), ["user_id"],
                         [F.col("session_start").asc_nulls_last(), F.col("session_id")], "__expected_seq")
    s_checks = {
        "session user FK broken": c("__u").isNotNull(),
        "session before user signup": c("session_start") >= c("signup_date").cast("timestamp_ntz"),
        "session sequence is not chronological": c("session_sequence_number") == c("__expected_seq"),
        "session_end before session_start": c("session_end") >= c("session_start"),
    }
    if campaigns is not None:
        camp = campaigns.select("campaign_id").withColumn("__c", F.lit(True))
        s = s.join(camp, "campaign_id", "left")
        s_checks["session campaign FK broken"] = c("__c").isNotNull()
    s_row = s.agg(*[_violations(p).alias(n) for n, p in s_checks.items()])
    s_row = s_row.crossJoin(_duplicate_keys(sessions, ["session_id"])
                            .withColumnRenamed("dups", "session_id not unique"))

    sess = sessions.select("session_id", c("user_id").alias("__s_user"), "session_start",
                           "session_end").withColumn("__s", F.lit(True))
    cars_k = cars.select("car_id", "inventory_exit_date").withColumn("__car", F.lit(True))
    ev = (events.join(sess, "session_id", "left")
          .join(users.select("user_id").withColumn("__eu", F.lit(True)), "user_id", "left")
          .join(cars_k, "car_id", "left"))
    e_checks = {
        "event user does not match session user": c("user_id") == c("__s_user"),
        "event user FK broken": c("__eu").isNotNull(),
        "event session FK broken": c("__s").isNotNull(),
        "event car FK broken": c("car_id").isNull() | c("__car").isNotNull(),
        "event before session start": c("event_timestamp") >= c("session_start"),
        "event after session end": c("event_timestamp") <= c("session_end") + F.expr("INTERVAL 1 SECOND"),
        "invalid event_name": c("event_name").isin(*CANONICAL_EVENTS),
        "purchase does not match inventory exit date":
            (c("event_name") != "purchase") | c("car_id").isNull()
            | (F.to_date("event_timestamp") == c("inventory_exit_date")),
    }
    if campaigns is not None:
        ev = ev.join(campaigns.select("campaign_id").withColumn("__ec", F.lit(True)), "campaign_id", "left")
        e_checks["event campaign FK broken"] = c("__ec").isNotNull()
    e_row = ev.agg(*[_violations(p).alias(n) for n, p in e_checks.items()])
    e_row = e_row.crossJoin(_duplicate_keys(events, ["event_id"])
                            .withColumnRenamed("dups", "event_id not unique"))
    multi_purchase = (events.filter((c("event_name") == "purchase") & c("car_id").isNotNull())
                      .groupBy("car_id").agg(F.count(F.lit(1)).alias("n"))
                      .agg(F.count_if(c("n") > 1).alias("car has multiple purchase events")))
    e_row = e_row.crossJoin(multi_purchase)
    return _long("sessions", s_row, ["session_id not unique", *s_checks]).unionByName(
        _long("events", e_row, ["event_id not unique", *e_checks, "car has multiple purchase events"]))


# ---------------------------------------------------------------------------- M4
def validate_impressions(impressions: DataFrame, sessions: DataFrame, events: DataFrame,
                         cars: DataFrame) -> DataFrame:
    c = F.col
    sess = sessions.select("session_id", c("user_id").alias("__s_user")).withColumn("__s", F.lit(True))
    ev_keys = (events.filter(c("event_name").isin("booking_complete", "purchase") & c("car_id").isNotNull())
               .groupBy("session_id", "car_id")
               .agg(F.max(c("event_name") == "booking_complete").alias("__has_booking"),
                    F.max(c("event_name") == "purchase").alias("__has_purchase")))
    imp = (impressions.join(sess, "session_id", "left")
           .join(cars.select("car_id").withColumn("__car", F.lit(True)), "car_id", "left")
           .join(ev_keys, ["session_id", "car_id"], "left"))
    clicked, booked, purchased = (F.coalesce(c(x), F.lit(False)) for x in ("clicked", "booked", "purchased"))
    checks = {
        "impression session FK broken": c("__s").isNotNull(),
        "impression car FK broken": c("__car").isNotNull(),
        "impression user does not match session user": c("user_id") == c("__s_user"),
        "clicked impression was not examined": ~clicked | c("examined"),
        "booked impression was not clicked": ~booked | c("clicked"),
        "purchased impression was not booked": ~purchased | c("booked"),
        "booked impression missing booking_complete event": ~booked | F.coalesce(c("__has_booking"), F.lit(False)),
        "purchased impression missing purchase event": ~purchased | F.coalesce(c("__has_purchase"), F.lit(False)),
    }
    row = imp.agg(*[_violations(p).alias(n) for n, p in checks.items()])
    row = row.crossJoin(_duplicate_keys(impressions, ["session_id", "car_id"])
                        .withColumnRenamed("dups", "impression key not unique"))
    return _long("impressions", row, ["impression key not unique", *checks])


# ---------------------------------------------------------------------------- M5
def validate_feature_list(features: list[str]) -> list[str]:
    """Leakage guard over a feature *schema* (column names, not data)."""
    bad = sorted(set(FORBIDDEN_FEATURES).intersection(features))
    return [f"leakage feature present: {bad}"] if bad else []


# ---------------------------------------------------------------------------- M6
def validation_report(tables: dict[str, DataFrame]) -> DataFrame:
    return (validate_cars(tables["cars"])
            .unionByName(validate_users(tables["users"]))
            .unionByName(validate_sessions_events(tables["sessions"], tables["events"], tables["users"],
                                                  tables["cars"], tables.get("campaigns")))
            .unionByName(validate_impressions(tables["impressions"], tables["sessions"],
                                              tables["events"], tables["cars"])))


def validate_all(tables: dict[str, DataFrame], raise_on_error: bool = True) -> list[str]:
    """Messages for every failed check; raise if any when ``raise_on_error``.
    The collected report has one row per check (a fixed, small bound)."""
    failed = validation_report(tables).filter(F.col("violations") > 0).collect()
    errors = [f"{r.table_name}: {r.check_name} ({r.violations})" for r in failed]
    if errors and raise_on_error:
        raise ValidationError("; ".join(errors))
    return errors
