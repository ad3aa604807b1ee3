"""Flattened GA4 export -> canonical ``events`` and ``sessions``.

The transform is one lazy plan.  Contract failures (bad timestamps, unmapped
names in ``error`` mode, nothing left, duplicate ids) are found by a single
aggregate action over the input before anything is written; the only values
brought to the driver are counts and at most 20 example names.

Differences from a row-ordered pandas implementation: Spark has no row order,
so the ordinal that disambiguates generated event ids is the row number over
(session, timestamp, canonical name, remaining input columns).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.contracts import CANONICAL_EVENTS, GA4_EVENT_MAP, GA4_REQUIRED
from lotwise.functions import stable_id
from lotwise.operators.ranks import group_row_number
from lotwise.sources.io import conform, read_table, write_parquet


class GA4ContractError(ValueError):
    """A flattened export cannot satisfy the canonical contract."""


OPTIONAL_DEFAULTS = {
    "traffic_source": "(direct)", "traffic_medium": "(none)",
    "campaign_id": "GA4_UNATTRIBUTED", "device_category": "unknown", "geo_city": "unknown",
}


def _optional(df: DataFrame, name: str, default=None) -> Column:
    """The column when present, else a literal default."""
    return F.col(name) if name in df.columns else F.lit(default)


def _parsed_timestamp(df: DataFrame) -> Column:
    """UTC instant -> zone-less wall clock (N2).  Strings may carry a zone
    suffix ('Z', '+05:30'); zone-less strings are taken as UTC."""
    # The session zone is pinned to UTC (lotwise.session), so instant -> NTZ
    # gives the UTC wall clock.
    dtype = dict(df.dtypes)["event_timestamp"]
    if dtype == "timestamp_ntz":
        return F.col("event_timestamp")
    if dtype == "timestamp":
        return F.col("event_timestamp").cast("timestamp_ntz")
    return F.try_to_timestamp(F.col("event_timestamp").cast("string")).cast("timestamp_ntz")


def _canonical_name(name: Column) -> Column:
    mapping = F.create_map(*[F.lit(x) for kv in GA4_EVENT_MAP.items() for x in kv])
    return F.coalesce(mapping[name], F.when(name.isin(*CANONICAL_EVENTS), name))


def canonicalise(frame: DataFrame, unknown_events: str = "drop") -> DataFrame:
    """N1-N5 as a lazy plan: required fields, timestamp parse, name mapping,
    stable ids, column mapping with defaults.  Rows with an unmapped name are
    dropped here; ``check_contract`` decides whether that is an error."""
    missing = sorted(set(GA4_REQUIRED) - set(frame.columns))
    if missing:
        raise GA4ContractError(f"missing required GA4 fields: {missing}")
    if unknown_events not in {"drop", "error"}:
        raise GA4ContractError("unknown_events must be 'drop' or 'error'")
    src = (frame.withColumn("__ts", _parsed_timestamp(frame))
                .withColumn("__name", _canonical_name(F.col("event_name").cast("string"))))
    src = src.filter(F.col("__name").isNotNull())
    user = F.col("user_pseudo_id").cast("string")
    src = (src.withColumn("__user", stable_id("GA4U", user))
              .withColumn("__session", stable_id("GA4S", user, F.col("ga_session_id"))))
    given = _optional(src, "event_id").cast("string")
    has_given = given.isNotNull() & (given != "")
    # Ordinal for generated ids: deterministic row number inside the session,
    # computed only for rows that lack a usable given id.
    others = [F.col(c).cast("string").asc_nulls_last() for c in sorted(frame.columns)
              if c not in ("ga_session_id", "user_pseudo_id")]
    keyed = src.filter(has_given).withColumn("__ordinal", F.lit(None).cast("int"))
    unkeyed = group_row_number(src.filter(~has_given), ["__session"],
                               [F.col("__ts").asc_nulls_last(), F.col("__name"), *others], "__ordinal")
    src = keyed.unionByName(unkeyed) if "event_id" in frame.columns else unkeyed
    event_id = F.when(has_given, given).otherwise(
        stable_id("GA4E", F.col("__session"), F.col("__ts").cast("string"), F.col("__name"),
                  (F.col("__ordinal") - 1).cast("string")))
    msec = F.coalesce(_optional(src, "engagement_time_msec", 0).try_cast("double"), F.lit(0.0))
    events = src.select(
        event_id.alias("event_id"),
        F.col("__ts").alias("event_timestamp"),
        F.to_date("__ts").alias("event_date"),
        F.col("__user").alias("user_id"),
        F.col("__session").alias("session_id"),
        F.col("__name").alias("event_name"),
        _optional(src, "item_id").cast("string").alias("car_id"),
        _optional(src, "item_list_id").cast("string").alias("item_list_id"),
        _optional(src, "item_list_index").try_cast("double").cast("int").alias("list_position"),
        _optional(src, "search_term").cast("string").alias("search_term"),
        _optional(src, "filter_name").cast("string").alias("filter_name"),
        _optional(src, "filter_value").cast("string").alias("filter_value"),
        (msec / 1000.0).alias("engagement_time_seconds"),
        _optional(src, "page_location").cast("string").alias("page_location"),
        *[F.coalesce(_optional(src, k).cast("string"), F.lit(v)).alias(out)
          for k, v, out in (("traffic_source", "(direct)", "source"),
                            ("traffic_medium", "(none)", "medium"),
                            ("campaign_id", "GA4_UNATTRIBUTED", "campaign_id"),
                            ("device_category", "unknown", "device_category"),
                            ("geo_city", "unknown", "city"))],
    )
    return conform(events, "events")


def check_contract(frame: DataFrame, events: DataFrame, unknown_events: str = "drop") -> None:
    """One aggregate over the input and one over the output; raises
    ``GA4ContractError`` on the first failed rule."""
    ts = _parsed_timestamp(frame)
    name = _canonical_name(F.col("event_name").cast("string"))
    stats = frame.agg(F.count_if(ts.isNull()).alias("bad_ts"),
                      F.count_if(name.isNull()).alias("unknown"),
                      F.count_if(name.isNotNull()).alias("kept")).first()
    if stats["bad_ts"]:
        raise GA4ContractError("event_timestamp contains invalid values")
    if stats["unknown"] and unknown_events == "error":
        names = [r[0] for r in frame.filter(name.isNull()).select(F.col("event_name").cast("string"))
                 .distinct().orderBy(1).limit(20).collect()]
        raise GA4ContractError(f"unmapped GA4 events: {names}")
    if not stats["kept"]:
        raise GA4ContractError("no canonical events remained after mapping")
    dups = events.groupBy("event_id").count().filter(F.col("count") > 1).limit(1).count()
    if dups:
        raise GA4ContractError("event_id is not unique")


def sessionise(events: DataFrame) -> DataFrame:
    """Session bounds, first-touch attributes, per-user sequence number."""
    order = F.struct("event_timestamp", "event_id")
    s = events.groupBy("session_id").agg(
        F.min_by("user_id", order).alias("user_id"),
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        *[F.min_by(c, order).alias(c) for c in ("campaign_id", "source", "medium",
                                                 "device_category", "city")])
    s = group_row_number(s, ["user_id"], [F.col("session_start").asc_nulls_last(), F.col("session_id")],
                         "session_sequence_number")
    s = s.withColumn("is_returning_user", F.col("session_sequence_number") > 1)
    return conform(s, "sessions")


def transform_flattened_ga4(frame: DataFrame, unknown_events: str = "drop",
                            validate: bool = True) -> tuple[DataFrame, DataFrame]:
    events = canonicalise(frame, unknown_events)
    if validate:
        check_contract(frame, events, unknown_events)
    return events, sessionise(events)


def import_flattened_ga4(spark: SparkSession, input_path: str, output_dir: str,
                         unknown_events: str = "drop") -> tuple[str, str]:
    """A10: CSV/Parquet export -> canonical Parquet (events partitioned by date)."""
    frame = read_table(spark, input_path)
    events, sessions = transform_flattened_ga4(frame, unknown_events)
    ev_path, s_path = f"{output_dir.rstrip('/')}/events", f"{output_dir.rstrip('/')}/sessions"
    write_parquet(events, ev_path, partition_by=["event_date"])
    write_parquet(sessions, s_path)
    return ev_path, s_path


# ------------------------------------------------------------------ driver data
GA4_NAME_BY_TYPE = (("view", "view_item"), ("click", "select_item"), ("signup", "generate_lead"),
                    ("purchase", "purchase"), ("error", "app_exception"))


def flattened_export_from_driver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flattened GA4-style export built from the driver's ``events`` table
    (ISO-8601 UTC strings, GA4 event names, anonymous ids, msec engagement);
    ``error`` rows become an unmapped name and are dropped by the adapter."""
    from lotwise.sources.driver_tables import key_count

    e = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    name = None
    for etype, ga4 in GA4_NAME_BY_TYPE:
        name = F.when(F.col("event_type") == etype, ga4) if name is None else \
            name.when(F.col("event_type") == etype, ga4)
    return e.select(
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("event_timestamp"),
        name.alias("event_name"),
        F.concat(F.lit("anon-"), F.col("user_id").cast("string")).alias("user_pseudo_id"),
        F.dayofyear("ts").cast("long").alias("ga_session_id"),
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("event_id"),
        F.when(F.col("event_type").isin("view", "click", "purchase"),
               (F.col("event_id") * 7919 % key_count(spark, sf_dir, "part")).cast("string")).alias("item_id"),
        (F.col("value") * 1000.0).alias("engagement_time_msec"),
        F.when(F.col("user_id") % 4 == 0, "google").alias("traffic_source"),
        F.when(F.col("user_id") % 4 == 0, "cpc").alias("traffic_medium"),
    )
