"""Segmented prefix scans: running totals per key whose work follows the rows, not the keys.

The rows are range-partitioned in (key, order), so a key with most of the rows lies in many partitions.
Each partition is scanned by itself; what a key has gathered in earlier partitions is its *carry*.  Only the
first key of a partition can have one, so carries are a table of at most one row per partition.

``segmented_sums`` scans sums with DataFrame functions.  ``decayed_vectors`` scans the monoid (time, vector):
two stretches compose to the later time and ``x * exp(-decay * (t2 - t1)) + y``, so no weight
ever grows with time.

Partitions are fixed by a checkpoint, so a lost executor finds the same ones again.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DoubleType, StructType

from lotwise.session import checkpoint_dir

_PART = "__part"


def _ranged(df: DataFrame, columns: list[str], n_partitions: int | None) -> DataFrame:
    n = n_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    checkpoint_dir(df.sparkSession)
    return (df.repartitionByRange(n, *columns).sortWithinPartitions(*columns)
            .withColumn(_PART, F.spark_partition_id()).checkpoint(eager=True))


def segmented_sums(df: DataFrame, keys: list[str], order: list[str], values: list[str],
                   prefix: str = "run_", n_partitions: int | None = None) -> DataFrame:
    """``keys, order`` and the inclusive running sum of each of ``values`` per key in ``order``: one row for each
    distinct (key, order), at which all its rows count.  Nulls in ``values`` add nothing; null keys are a
    key of their own."""
    rows = df.groupBy(*keys, *order).agg(*[F.sum(v).alias(v) for v in values])
    rows = _ranged(rows, [*keys, *order], n_partitions)
    inside = (Window.partitionBy(_PART, *keys).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = rows.select("*", *[F.sum(v).over(inside).alias(f"__w_{v}") for v in values])

    # Totals of the keys that go on in another partition: a partition's first and last one.
    ends = Window.partitionBy(_PART)
    first, last = (F.struct(*keys) for _ in range(2))
    totals = rows.groupBy(_PART, *keys).agg(*[F.sum(v).alias(f"__t_{v}") for v in values])
    totals = (totals.withColumn("__first", F.min(first).over(ends)).withColumn("__last", F.max(last).over(ends))
              .where((F.struct(*keys) == F.col("__first")) | (F.struct(*keys) == F.col("__last"))))
    before = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carries = totals.select(_PART, F.struct(*keys).alias("__key"), *[
        F.sum(f"__t_{v}").over(before).alias(f"__c_{v}") for v in values])
    carries = carries.where(F.coalesce(*[F.col(f"__c_{v}") for v in values]).isNotNull())
    # At most one row per partition: a proven bound for a broadcast.
    out = local.alias("l").join(F.broadcast(carries).alias("c"), (
        (F.col(f"l.{_PART}") == F.col(f"c.{_PART}"))
        & F.struct(*[F.col(f"l.{k}") for k in keys]).eqNullSafe(F.col("c.__key"))), "left")
    return out.select(*[F.col(f"l.{c}").alias(c) for c in (*keys, *order, *values)], *[
        (F.coalesce(F.col(f"l.__w_{v}"), F.lit(0)) + F.coalesce(F.col(f"c.__c_{v}"), F.lit(0))).alias(f"{prefix}{v}")
        for v in values])


# ---- decayed vectors ---------------------------------------------------------------------

class _State:
    """A key's gathered vector at a time."""

    def __init__(self, size: int, decay: float, time: float | None = None, vector=None):
        self.decay, self.time = decay, time
        self.vector = np.zeros(size) if vector is None else vector

    def at(self, time: float) -> np.ndarray:
        if self.time is not None and time != self.time:
            self.vector = self.vector * np.exp(-self.decay * (time - self.time))
        self.time = time
        return self.vector

    def add(self, time: float, places: np.ndarray, amounts: np.ndarray) -> None:
        vector = self.at(time)
        np.add.at(vector, places, amounts)


def _rows(batches):
    for batch in batches:
        columns = [batch.column(c) for c in ("key", "time", "places", "amounts", "wanted")]
        for key, time, places, amounts, wanted in zip(*(c.to_pylist() for c in columns)):
            yield key, time, places, amounts, wanted


def decayed_vectors(timeline: DataFrame, size: int, decay: float, tag: str = "wanted",
                    n_partitions: int | None = None) -> DataFrame:
    """``key, time, <tag>, vector``: for each row of ``timeline`` with a non-null ``tag`` its key's vector at its
    time, the sum over the key's rows up to then of ``amounts`` at ``places``, each decayed by
    ``exp(-decay * age)``.  ``timeline`` has ``key, time`` (a double), ``places, amounts`` (arrays, or null) and
    ``tag``; rows of equal time all count.  A vector has ``size`` places; a task holds one."""
    slim = timeline.select("key", "time", "places", "amounts", F.col(tag).alias("wanted"),
                           F.col(tag).isNotNull().alias("late"),
                           F.xxhash64("places", "amounts", tag).alias("tie"))
    rows = _ranged(slim, ["key", "time", "late", "tie"], n_partitions)
    key_type, tag_type = (to_arrow_type(rows.schema[c].dataType) for c in ("key", "wanted"))

    def ends(batches):
        first = state = last = None
        seen = False
        for key, time, places, amounts, _ in _rows(batches):
            if not seen:
                first = key
            if not seen or key != last:
                state, last, seen = _State(size, decay), key, True
            if places is not None:
                state.add(time, np.array(places), np.array(amounts, float))
            else:
                state.at(time)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([first], key_type),
                 pa.array([last], key_type), pa.array([state.time], pa.float64()),
                 pa.array([state.vector.tolist()], pa.list_(pa.float64()))],
                names=["part", "first", "last", "time", "vector"])

    end_schema = StructType().add("part", "integer")
    for name in ("first", "last"):
        end_schema = end_schema.add(name, rows.schema["key"].dataType)
    end_schema = end_schema.add("time", "double").add("vector", ArrayType(DoubleType()))
    found = sorted(rows.mapInArrow(ends, end_schema).collect(), key=lambda r: r["part"])
    carries, key, carried = {}, None, None      # one vector per partition reaches the driver
    for r in found:
        if carried is not None and r["first"] == key:
            carries[r["part"]] = (carried.time, carried.vector.copy())
        mine = _State(size, decay, r["time"], np.array(r["vector"]))
        if carried is not None and r["first"] == r["last"] == key:
            mine.vector = mine.vector + carried.at(r["time"])
        key, carried = r["last"], mine

    schema = StructType([rows.schema["key"], rows.schema["time"]])
    schema = schema.add(tag, rows.schema["wanted"].dataType).add("vector", ArrayType(DoubleType()))

    def scan(batches):
        state, last, out = None, None, []
        for key, time, places, amounts, wanted in _rows(batches):
            if state is None:
                state, last = _State(size, decay, *carries.get(TaskContext.get().partitionId(), ())), key
            elif key != last:
                state, last = _State(size, decay), key
            if places is not None:
                state.add(time, np.array(places), np.array(amounts, float))
            if wanted is not None:
                out.append((key, time, wanted, state.at(time).copy()))
            if len(out) >= 1000:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    def batch_of(out):
        keys, times, tags, vectors = zip(*out)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, key_type), pa.array(times, pa.float64()), pa.array(tags, tag_type),
             pa.array(list(vectors), pa.list_(pa.float64()))], names=schema.fieldNames())

    return rows.mapInArrow(scan, schema)


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays of doubles."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
