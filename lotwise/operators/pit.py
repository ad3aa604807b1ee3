"""Point-in-time counts (C11, C12) for leak-free features (O2).

"How many timeline rows with (time, kind) <= this observation" is a running total of
the timeline (facts and observations together) per key: ``scan.segmented_sums``, whose
partitions follow the rows, so neither a busy key nor a busy hour is one task's.
Facts of one key, time and kind are one row of it.

Ordering within equal times uses ``kind``: facts that count at ``<=`` sort before the
observation kind, facts that count only at ``<`` sort after it, which
reproduces ``searchsorted(side='right')`` and ``side='left'`` respectively.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.operators.scan import segmented_sums
from lotwise.session import checkpoint_dir

# Timeline kinds: entries/views count when <= t, exits only when < t.
ENTRY, VIEW, OBSERVATION, EXIT = 0, 1, 2, 3


def _ts(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def market_context(observations: DataFrame, cars: DataFrame, events: DataFrame,
                   obs_time: str = "observation_time") -> DataFrame:
    """Demand and live-supply context for each distinct (city, body_type, t).

    * market_demand_index = segment views <= t / (all views <= t / #segments),
      0.5 when no view at all precedes t; a view's segment is its car's.
    * local_supply_index = live segment cars / live city cars at t, 0 when the
      city has none; live = entered <= t and not exited < t.

    Returns (city, body_type, <obs_time>, market_demand_index, local_supply_index)
    for every distinct observation key, including NULL city/body keys (which
    get zero counts)."""
    checkpoint_dir(cars.sparkSession)
    # Four timelines read the keys: found once.
    obs = observations.select("city", "body_type", _ts(F.col(obs_time)).alias("t")).distinct().checkpoint(eager=True)
    seg = cars.select("car_id", "city", "body_type")
    views = (events.filter((F.col("event_name") == "view_item") & F.col("car_id").isNotNull())
             .select("car_id", _ts(F.col("event_timestamp")).alias("t"))
             .join(seg, "car_id", "inner"))
    inv = cars.select("city", "body_type", _ts(F.col("inventory_entry_date")).alias("entry"),
                      _ts(F.col("inventory_exit_date")).alias("exit"))

    def lit_cols(kind: int, dv: int, dl: int) -> list[Column]:
        return [F.lit(kind).alias("kind"), F.lit(dv).alias("dv"), F.lit(dl).alias("dl")]

    # Segment timeline: views, entries, exits and observations per (city, body).
    keyed = F.col("city").isNotNull() & F.col("body_type").isNotNull()
    seg_tl = (views.filter(keyed).select("city", "body_type", "t", *lit_cols(VIEW, 1, 0))
              .unionByName(inv.filter(keyed & F.col("entry").isNotNull())
                           .select("city", "body_type", F.col("entry").alias("t"), *lit_cols(ENTRY, 0, 1)))
              .unionByName(inv.filter(keyed & F.col("exit").isNotNull())
                           .select("city", "body_type", F.col("exit").alias("t"), *lit_cols(EXIT, 0, -1)))
              .unionByName(obs.filter(keyed).select("city", "body_type", "t", *lit_cols(OBSERVATION, 0, 0))))
    seg_run = (segmented_sums(seg_tl, ["city", "body_type"], ["t", "kind"], ["dv", "dl"])
               .filter(F.col("kind") == OBSERVATION)
               .select("city", "body_type", "t", F.col("run_dv").alias("demand_count"),
                       F.col("run_dl").alias("segment_live")))

    # City timeline: entries, exits and observations per city.
    city_obs = obs.filter(F.col("city").isNotNull()).select("city", "t").distinct()
    city_tl = (inv.filter(F.col("city").isNotNull() & F.col("entry").isNotNull())
               .select("city", F.col("entry").alias("t"), *lit_cols(ENTRY, 0, 1))
               .unionByName(inv.filter(F.col("city").isNotNull() & F.col("exit").isNotNull())
                            .select("city", F.col("exit").alias("t"), *lit_cols(EXIT, 0, -1)))
               .unionByName(city_obs.select("city", "t", *lit_cols(OBSERVATION, 0, 0))))
    city_run = (segmented_sums(city_tl, ["city"], ["t", "kind"], ["dl"])
                .filter(F.col("kind") == OBSERVATION)
                .select("city", "t", F.col("run_dl").alias("city_live")))

    # Global view timeline: one running count over time.
    all_obs = obs.select("t").distinct()
    glob_tl = (views.select("t", *lit_cols(VIEW, 1, 0))
               .unionByName(all_obs.select("t", *lit_cols(OBSERVATION, 0, 0))))
    glob_tl = glob_tl.withColumn("__all", F.lit(0))
    glob_run = (segmented_sums(glob_tl, ["__all"], ["t", "kind"], ["dv"])
                .filter(F.col("kind") == OBSERVATION)
                .select("t", F.col("run_dv").alias("total_views")))

    n_segments = cars.select("city", "body_type").distinct().agg(
        F.greatest(F.count(F.lit(1)), F.lit(1)).alias("n_segments"))

    # Running totals carry non-null keys only, so NULL-keyed observations find
    # no match and keep zero counts, as a group-by that drops NULL keys would.
    out = (obs.join(seg_run, ["city", "body_type", "t"], "left")
              .join(city_run, ["city", "t"], "left")
              .join(glob_run, "t", "left")
              .crossJoin(F.broadcast(n_segments)))
    avg_demand = F.coalesce(F.col("total_views"), F.lit(0)) / F.col("n_segments")
    demand = F.coalesce(F.col("demand_count"), F.lit(0)).cast("double")
    city_live = F.coalesce(F.col("city_live"), F.lit(0)).cast("double")
    seg_live = F.coalesce(F.col("segment_live"), F.lit(0)).cast("double")
    return out.select(
        "city", "body_type", F.col("t").alias(obs_time),
        F.when(avg_demand > 0, demand / avg_demand).otherwise(F.lit(0.5)).alias("market_demand_index"),
        F.when(city_live > 0, seg_live / city_live).otherwise(F.lit(0.0)).alias("local_supply_index"))


def attach_market_context(rows: DataFrame, cars: DataFrame, events: DataFrame,
                          obs_col: str, observations: DataFrame | None = None) -> DataFrame:
    """Join the (city, body_type, time) context back onto ``rows`` (null-safe).  ``observations`` are the same
    ``city, body_type, <obs_col>``, found without what else ``rows`` have joined."""
    drop = [c for c in ("market_demand_index", "local_supply_index") if c in rows.columns]
    r = rows.drop(*drop).withColumn("__obs_t", _ts(F.col(obs_col)))
    keys = r if observations is None else observations.withColumn("__obs_t", _ts(F.col(obs_col)))
    ctx = market_context(keys.select("city", "body_type", "__obs_t"), cars, events, "__obs_t").select(
        F.col("city").alias("__c_city"), F.col("body_type").alias("__c_body"),
        F.col("__obs_t").alias("__c_t"), "market_demand_index", "local_supply_index")
    cond = [r["city"].eqNullSafe(ctx["__c_city"]), r["body_type"].eqNullSafe(ctx["__c_body"]),
            r["__obs_t"] == ctx["__c_t"]]
    return r.join(ctx, cond, "left").drop("__c_city", "__c_body", "__c_t", "__obs_t")
