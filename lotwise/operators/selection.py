"""Exact quantiles by distributed selection, for columns and groups that no task can hold.

``percentile`` and ``median`` keep a map of all distinct values of a group in one task.  Here:

* ``exact_quantiles`` narrows value ranges over passes: each pass counts the rows of ``BUCKETS`` equal parts of
  every range that still holds a wanted rank, all columns and quantiles at once, and goes on in the part with the
  rank, between its least and greatest value.  A task counts its rows in arrays; a pass sends at most ``BUCKETS``
  rows per wanted rank to the driver; two to five passes end it for usual data.
* ``group_quantiles`` counts distinct (group, value) rows, sums the counts up in order by a segmented scan,
  whose partitions follow the rows, and reads the values at the wanted ranks.

Both interpolate as ``percentile`` does: rank ``(n - 1) * q``, linear between neighbours.  Nulls
don't count; a column or group without values has null quantiles.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.operators.scan import segmented_sums
from lotwise.session import ship_package

BUCKETS = 1024


@dataclass
class _Search:
    """A range of a column's values that holds the value of a rank (from 0 within the range)."""

    column: int
    rank: int
    low: float
    high: float


def _entry(value: Column, ranges: list[tuple[int, float, float]]) -> Column:
    """The range that holds ``value`` (null: none does), which part of it, and the value.  ``ranges`` are those of
    one column as ``(number, low, high)`` by ``low``; they don't overlap, so a row has one entry for a column,
    however many ranks are wanted.  Halves keep the width finite."""
    below = sum((F.when(value >= low, 1).otherwise(0) for _, low, _ in ranges), F.lit(0)) - 1
    number, low, high = (F.get(F.array(*[F.lit(r[i]) for r in ranges]), below) for i in range(3))
    place = (value / 2 - low / 2) / (high / 2 - low / 2) * BUCKETS
    bucket = F.least(F.floor(place).cast("int"), F.lit(BUCKETS - 1))
    return F.struct(F.when(value <= high, number).alias("range"), F.when(value <= high, bucket).alias("bucket"),
                    value.alias("value"))


def _counted(of_column: dict[int, list[tuple[int, float, float]]], ranges: int):
    """Rows of a task by range and bucket, as ``_entry`` places them, with the least and greatest value.  The
    ends of all ranges are finite."""
    def counted(batches):
        n = np.zeros(ranges * BUCKETS, np.int64)
        least, greatest = np.full(ranges * BUCKETS, np.inf), np.full(ranges * BUCKETS, -np.inf)
        for batch in batches:
            for c, of in of_column.items():
                numbers, lows, highs = (np.array(x) for x in zip(*of))
                column = batch.column(f"v{c}")
                value = np.asarray(column.drop_null() if column.null_count else column)
                below = np.searchsorted(lows, value, side="right") - 1
                inside = (below >= 0) & (value <= highs.take(below))
                value, below = value[inside], below[inside]
                low, high = lows.take(below), highs.take(below)
                place = (value / 2 - low / 2) / (high / 2 - low / 2) * BUCKETS
                at = numbers.take(below) * BUCKETS + np.minimum(place.astype(np.int64), BUCKETS - 1)
                n += np.bincount(at, minlength=len(n))
                np.minimum.at(least, at, value)
                np.maximum.at(greatest, at, value)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array((some // BUCKETS).astype(np.int32)), pa.array((some % BUCKETS).astype(np.int32)),
             pa.array(n[some]), pa.array(least[some]), pa.array(greatest[some])],
            names=["range", "bucket", "n", "low", "high"])
    return counted


def exact_quantiles(df: DataFrame, columns: list[str], quantiles: list[float]) -> dict[str, list]:
    """``{column: [value of each quantile]}``."""
    values = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    row = values.agg(*[f(F.col(f"v{i}")).alias(f"{name}{i}") for i in range(len(columns)) for name, f in (
        ("n", F.count), ("low", F.min), ("high", F.max))]).first()
    wanted, searches, found = {}, {}, {}
    for i in range(len(columns)):
        n = row[f"n{i}"]
        for q in quantiles if n else ():
            place = (n - 1) * q
            wanted[i, q] = place
            for rank in {math.floor(place), math.ceil(place)}:
                searches[i, rank] = _Search(i, rank, row[f"low{i}"], row[f"high{i}"])
    while searches:
        for key in [k for k, s in searches.items() if s.low == s.high]:
            found[key] = searches.pop(key).low
        ranges = sorted({(s.column, s.low, s.high) for s in searches.values()})
        if not ranges:
            break
        of_column: dict[int, list] = {}
        for k, (c, low, high) in enumerate(ranges):
            of_column.setdefault(c, []).append((k, low, high))
        if all(math.isfinite(end) for _, low, high in ranges for end in (low, high)):
            ship_package(df.sparkSession)
            cells = (values.select(*[f"v{c}" for c in of_column])
                     .mapInArrow(_counted(of_column, len(ranges)), "range int, bucket int, n long, low double, high double"))
        else:
            entries = F.array(*[_entry(F.col(f"v{c}"), of) for c, of in of_column.items()])
            cells = (values.select(F.explode(entries).alias("e")).select("e.*").where("range is not null")
                     .select("range", "bucket", F.lit(1).alias("n"), F.col("value").alias("low"),
                             F.col("value").alias("high")))
        counted = (cells.groupBy("range", "bucket")
                   .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).collect())
        parts: dict[tuple, list] = {r: [] for r in ranges}
        for r in sorted(counted, key=lambda r: r["bucket"]):
            parts[ranges[r["range"]]].append(r)
        for s in searches.values():
            before = 0
            for r in parts[s.column, s.low, s.high]:
                if s.rank < before + r["n"]:
                    s.rank, s.low, s.high = s.rank - before, r["low"], r["high"]
                    break
                before += r["n"]
    out: dict[str, list] = {}
    for i, c in enumerate(columns):
        out[c] = []
        for q in quantiles:
            if (i, q) not in wanted:
                out[c].append(None)
                continue
            place = wanted[i, q]
            low, high = found[i, math.floor(place)], found[i, math.ceil(place)]
            out[c].append(low if low == high else
                          (math.ceil(place) - place) * low + (place - math.floor(place)) * high)
    return out


def group_quantiles(df: DataFrame, by: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """``by`` and a column for each of ``quantiles`` (name: quantile) of ``value`` in the group."""
    keys = [f"__k{i}" for i in range(len(by))]
    rows = df.select(*[F.col(b).alias(k) for b, k in zip(by, keys)], F.col(value).cast("double").alias("__v"))
    counts = rows.where("__v is not null").withColumn("__n", F.lit(1))
    run = segmented_sums(counts, keys, ["__v"], ["__n"])
    sizes = rows.groupBy(*keys).agg(F.count("__v").alias("__size"))
    both = run.alias("r").join(sizes.alias("s"), [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys], "right")
    through, before = F.col("run___n"), F.col("run___n") - F.col("__n")
    picks = []
    for name, q in quantiles.items():
        place = (F.col("__size") - 1) * F.lit(float(q))
        for end, rank in (("low", F.floor(place)), ("high", F.ceil(place))):
            picks.append(F.max(F.when((rank >= before) & (rank < through), F.col("__v"))).alias(f"{name}__{end}"))
    picked = both.groupBy(*[F.col(f"s.{k}").alias(b) for k, b in zip(keys, by)]).agg(
        F.max("__size").alias("__size"), *picks)

    def value_of(name: str, q: float) -> Column:
        place = (F.col("__size") - 1) * F.lit(float(q))
        low, high = F.col(f"{name}__low"), F.col(f"{name}__high")
        between = (F.ceil(place) - place) * low + (place - F.floor(place)) * high
        return F.when(low == high, low).otherwise(between).alias(name)

    return picked.select(*by, *[value_of(n, q) for n, q in quantiles.items()])


def join_quantiles(grouped: DataFrame, rows: DataFrame, by: list[str], value: str,
                   quantiles: dict[str, float]) -> DataFrame:
    """``grouped`` (one row per group of ``by``) with the quantiles of ``value`` over ``rows``."""
    keys = [f"__j{i}" for i in range(len(by))]
    found = group_quantiles(rows, by, value, quantiles).select(
        *[F.col(b).alias(k) for b, k in zip(by, keys)], *quantiles)
    return grouped.join(found, [grouped[b].eqNullSafe(F.col(k)) for b, k in zip(by, keys)], "left").drop(*keys)


def column_median(df: DataFrame, column: str) -> Column:
    """The exact median of a column as a literal (null without values)."""
    return F.lit(exact_quantiles(df, [column], [0.5])[column][0]).cast("double")
