"""Exploration and serving-side data rules.

These are the data operations behind the reference's dashboards and API
endpoints, expressed as batch DataFrame jobs over whole tables.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.functions import clip_lower
from lotwise.operators.pit import attach_market_context
from lotwise.operators.selection import column_median, group_quantiles


# --------------------------------------------------------------------------- D20
def missing_share(df: DataFrame, top: int = 8) -> DataFrame:
    """Share of NULLs per column, largest first (top ``top``)."""
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    long = row.selectExpr(f"stack({len(df.columns)}, {stack}) AS (column_name, missing_share)")
    return long.orderBy(F.col("missing_share").desc(), "column_name").limit(top)


# --------------------------------------------------------------------------- D21
def monthly_volume(events: DataFrame) -> DataFrame:
    return (events.groupBy(F.trunc("event_date", "MM").alias("month"))
            .agg(F.count(F.lit(1)).cast("long").alias("events")))


# --------------------------------------------------------------------------- D22
def retention_matrix(retention: DataFrame) -> DataFrame:
    """Cohort x months-since-signup retention matrix.  The pivot values are
    the observed month offsets (a small distinct set), passed explicitly so the
    pivot needs no extra pass."""
    months = sorted(r[0] for r in retention.select("months_since_signup").distinct().collect())
    return (retention.groupBy("cohort_month").pivot("months_since_signup", months)
            .agg(F.first("retention_rate")))


# --------------------------------------------------------------------------- D23
def aging_rollup(aging: DataFrame, city: str | None = None, body_type: str | None = None) -> DataFrame:
    d = aging
    if city:
        d = d.filter(F.col("city") == city)
    if body_type:
        d = d.filter(F.col("body_type") == body_type)
    return d.groupBy("aging_bucket").agg(F.sum("n_cars").cast("long").alias("n_cars"))


# --------------------------------------------------------------------------- D24
def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).cast("long").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = c if out is None else out.unionByName(c)
    return out


# --------------------------------------------------------------------------- D25
def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width histogram over [min, max]: (bin 1..bins, lower, upper, n).
    The maximum falls in the last bin."""
    mm = df.agg(F.min(col).alias("__lo"), F.max(col).alias("__hi"))
    w = (F.col("__hi") - F.col("__lo")) / bins
    b = F.when(F.col("__hi") == F.col("__lo"), F.lit(1)).otherwise(
        F.least(F.floor((F.col(col) - F.col("__lo")) / w) + 1, F.lit(bins)))
    return (df.filter(F.col(col).isNotNull()).crossJoin(F.broadcast(mm))
            .groupBy(b.cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).cast("long").alias("n"), F.first("__lo").alias("__lo"),
                 F.first("__hi").alias("__hi"))
            .select("bin", (F.col("__lo") + (F.col("bin") - 1) * (F.col("__hi") - F.col("__lo")) / bins).alias("lower"),
                    (F.col("__lo") + F.col("bin") * (F.col("__hi") - F.col("__lo")) / bins).alias("upper"), "n"))


# ---------------------------------------------------------------------------- F6
def most_active_users(events: DataFrame, top: int = 200) -> DataFrame:
    return (events.groupBy("user_id").agg(F.count(F.lit(1)).cast("long").alias("events"))
            .orderBy(F.col("events").desc(), "user_id").limit(top))


# --------------------------------------------------------------------------- C17
def latest_snapshot_at_or_before(snapshots: DataFrame, requests: DataFrame,
                                 key: str = "car_id", age: str = "snapshot_age") -> DataFrame:
    """For each request (key, requested_age): the car's latest snapshot with
    age <= requested age, else its first snapshot (one grouped pass)."""
    j = requests.select(key, F.col(age).alias("__req")).join(snapshots, key, "inner")
    row = F.struct(*[F.col(c) for c in snapshots.columns])
    picked = j.groupBy(key, "__req").agg(
        F.max_by(F.when(F.col(age) <= F.col("__req"), row), F.when(F.col(age) <= F.col("__req"), F.col(age)))
        .alias("__le"),
        F.min_by(row, F.col(age)).alias("__first"))
    return picked.select(F.coalesce("__le", "__first").alias("__s"), F.col("__req").alias("requested_age")) \
        .select("requested_age", "__s.*")


# --------------------------------------------------------------------------- L13
def price_features_as_of_latest(candidates: DataFrame, cars: DataFrame, events: DataFrame) -> DataFrame:
    """Price features for cars not (yet) listed, observed at the latest event
    time: age and km/year at that year, entry month, make+model median
    popularity (global median fallback) and market context."""
    as_of = events.agg(F.max("event_timestamp").alias("observation_date"))
    mm = group_quantiles(cars, ["make", "model"], "model_popularity", {"__mm": 0.5})
    c = (candidates.crossJoin(F.broadcast(as_of))
         .join(mm, ["make", "model"], "left")
         .withColumn("registration_year", F.coalesce("registration_year", "manufacturing_year"))
         .withColumn("vehicle_age", clip_lower(F.year("observation_date") - F.col("manufacturing_year"), 0).cast("int"))
         .withColumn("kilometres_per_year", F.col("kilometres_driven") / F.greatest(F.col("vehicle_age"), F.lit(1)))
         .withColumn("inventory_entry_month", F.month("observation_date"))
         .withColumn("model_popularity", F.coalesce("__mm", column_median(cars, "model_popularity")))
         .drop("__mm"))
    return attach_market_context(c, cars, events, "observation_date")
