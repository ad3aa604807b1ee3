"""Structured Streaming variant of the GA4 canonicaliser (optional §2.I).

Flattened GA4 files landing in a directory are canonicalised row by row
(timestamp parse, name mapping, stable ids, defaults), de-duplicated on
``event_id`` within a watermark, and appended to partitioned Parquet with
exactly-once file-sink semantics.  Sessionisation stays a batch job
(``lotwise.sources.ga4.sessionise``) over the written events.

Difference from batch: a stream has no complete session to number rows in,
so an event without a given id gets a stable hash of *all* its input columns
(exact duplicate rows share an id and the watermark dedup keeps one).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.functions import stable_id
from lotwise.sources.ga4 import GA4ContractError, _canonical_name, _optional, _parsed_timestamp
from lotwise.sources.io import conform
from lotwise.contracts import GA4_REQUIRED

GA4_STREAM_SCHEMA = T.StructType([
    T.StructField("event_timestamp", T.StringType()), T.StructField("event_name", T.StringType()),
    T.StructField("user_pseudo_id", T.StringType()), T.StructField("ga_session_id", T.LongType()),
    T.StructField("event_id", T.StringType()), T.StructField("item_id", T.StringType()),
    T.StructField("item_list_id", T.StringType()), T.StructField("item_list_index", T.StringType()),
    T.StructField("search_term", T.StringType()), T.StructField("filter_name", T.StringType()),
    T.StructField("filter_value", T.StringType()), T.StructField("engagement_time_msec", T.DoubleType()),
    T.StructField("page_location", T.StringType()), T.StructField("traffic_source", T.StringType()),
    T.StructField("traffic_medium", T.StringType()), T.StructField("campaign_id", T.StringType()),
    T.StructField("device_category", T.StringType()), T.StructField("geo_city", T.StringType()),
])


def canonicalise_stream(frame: DataFrame) -> DataFrame:
    """Row-wise canonicalisation usable on a streaming DataFrame; unmapped
    names and unparseable timestamps are dropped (a stream cannot fail the
    whole input the way the batch contract check does)."""
    missing = sorted(set(GA4_REQUIRED) - set(frame.columns))
    if missing:
        raise GA4ContractError(f"missing required GA4 fields: {missing}")
    src = (frame.withColumn("__ts", _parsed_timestamp(frame))
                .withColumn("__name", _canonical_name(F.col("event_name").cast("string")))
                .filter(F.col("__ts").isNotNull() & F.col("__name").isNotNull()))
    user = F.col("user_pseudo_id").cast("string")
    session = stable_id("GA4S", user, F.col("ga_session_id"))
    given = _optional(src, "event_id").cast("string")
    all_cols = [F.col(c) for c in sorted(frame.columns)]
    event_id = F.when(given.isNotNull() & (given != ""), given).otherwise(
        stable_id("GA4E", session, F.col("__ts").cast("string"), F.col("__name"), *all_cols))
    msec = F.coalesce(_optional(src, "engagement_time_msec", 0).try_cast("double"), F.lit(0.0))
    events = src.select(
        event_id.alias("event_id"), F.col("__ts").alias("event_timestamp"), F.to_date("__ts").alias("event_date"),
        stable_id("GA4U", user).alias("user_id"), session.alias("session_id"), F.col("__name").alias("event_name"),
        _optional(src, "item_id").cast("string").alias("car_id"),
        _optional(src, "item_list_id").cast("string").alias("item_list_id"),
        _optional(src, "item_list_index").try_cast("double").cast("int").alias("list_position"),
        _optional(src, "search_term").cast("string").alias("search_term"),
        _optional(src, "filter_name").cast("string").alias("filter_name"),
        _optional(src, "filter_value").cast("string").alias("filter_value"),
        (msec / 1000.0).alias("engagement_time_seconds"),
        _optional(src, "page_location").cast("string").alias("page_location"),
        *[F.coalesce(_optional(src, k).cast("string"), F.lit(v)).alias(out)
          for k, v, out in (("traffic_source", "(direct)", "source"), ("traffic_medium", "(none)", "medium"),
                            ("campaign_id", "GA4_UNATTRIBUTED", "campaign_id"),
                            ("device_category", "unknown", "device_category"), ("geo_city", "unknown", "city"))])
    return conform(events, "events")


def start_ga4_stream(spark: SparkSession, input_dir: str, output_dir: str, checkpoint: str,
                     fmt: str = "parquet", watermark: str = "1 hour", available_now: bool = True):
    """readStream -> canonicalise -> watermark dedup on event_id -> parquet."""
    reader = spark.readStream.schema(GA4_STREAM_SCHEMA)
    if fmt == "csv":
        reader = reader.option("header", True)
    raw = reader.format(fmt).load(input_dir)
    # watermarks need an instant (TIMESTAMP); the session zone is UTC, so the
    # cast keeps the wall clock
    events = (canonicalise_stream(raw)
              .withColumn("__event_instant", F.col("event_timestamp").cast("timestamp"))
              .withWatermark("__event_instant", watermark)
              .dropDuplicatesWithinWatermark(["event_id"])
              .drop("__event_instant"))
    writer = (events.writeStream.format("parquet").option("path", output_dir)
              .option("checkpointLocation", checkpoint).partitionBy("event_date").outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
