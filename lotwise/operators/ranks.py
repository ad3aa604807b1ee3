"""Exact global ranks without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves the whole table into one
task.  ``global_row_number`` instead:

1. range-partitions on the (unique) ordering key - Spark samples the key to
   pick balanced bounds, so even a value held by a third of all rows is spread
   over many partitions because the tie-break column differs;
2. sorts within each partition and numbers rows locally
   (``monotonically_increasing_id`` is contiguous inside a partition);
3. counts rows per partition (one tiny row per partition), prefix-sums the
   counts, and adds the offset back with a broadcast join whose size is bounded
   by the number of partitions.

Range bounds come from a sample, and a sample of shuffle output is not
reproducible, so the numbered partitions are materialised once with a reliable
``checkpoint()`` into ``spark.checkpoint.dir``: both branches then read the same
stored (partition id, local index) values, and a lost executor re-reads the
checkpoint instead of recomputing different bounds.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.session import checkpoint_dir

_PID, _LOCAL = "__pid", "__local"


def _n_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def global_row_number(df: DataFrame, order: list[Column], out: str = "row_number",
                      n_partitions: int | None = None, total: str | None = None) -> DataFrame:
    """1-based ``row_number() OVER (ORDER BY order)``; ``order`` must be unique.
    With ``total`` set, the table's row count is attached under that name."""
    parts = _n_partitions(df, n_partitions)
    checkpoint_dir(df.sparkSession)
    ranged = (df.repartitionByRange(parts, *order)
                .sortWithinPartitions(*order)
                .withColumn(_PID, F.spark_partition_id())
                .withColumn(_LOCAL, F.monotonically_increasing_id()
                            - F.shiftleft(F.col(_PID).cast("long"), 33))
                .checkpoint(eager=True))
    counts = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        _PID,
        (F.sum("__n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)))
        .alias("__offset"),
        F.sum("__n").over(Window.partitionBy()).alias("__total"))
    # ``offsets`` has one row per partition: a proven bound for a broadcast.
    ranked = ranged.join(F.broadcast(offsets), _PID, "inner")
    ranked = ranked.withColumn(out, (F.coalesce(F.col("__offset"), F.lit(0)) + F.col(_LOCAL) + 1)
                               .cast("long"))
    if total:
        return ranked.withColumnRenamed("__total", total).drop(_PID, _LOCAL, "__offset")
    return ranked.drop(_PID, _LOCAL, "__offset", "__total")


def with_ntile(df: DataFrame, order: list[Column], k: int, out: str,
               n_partitions: int | None = None) -> DataFrame:
    """``NTILE(k) OVER (ORDER BY order)`` distributed: the first ``n mod k`` tiles
    get one extra row, as SQL NTILE does."""
    rn = f"__rn_{out}"
    ranked = global_row_number(df, order, rn, n_partitions, total="__total")
    n, r = F.col("__total"), F.col(rn)
    q = F.floor(n / k)
    rem = n - q * k
    big = (q + 1) * rem
    tile = F.when(q == 0, r).when(r <= big, F.ceil(r / (q + 1))) \
            .otherwise(rem + F.ceil((r - big) / q))
    return ranked.withColumn(out, tile.cast("long")).drop(rn, "__total")


def with_decile_by_rank(df: DataFrame, order: list[Column], deciles: int, out: str,
                        n_partitions: int | None = None) -> DataFrame:
    """Decile as ``index * deciles // n + 1`` over 0-based rank (E9); unlike NTILE
    the larger groups are spread rather than first."""
    rn = f"__rn_{out}"
    ranked = global_row_number(df, order, rn, n_partitions, total="__total")
    dec = F.floor((F.col(rn) - 1) * deciles / F.col("__total")) + 1
    return ranked.withColumn(out, dec.cast("long")).drop(rn, "__total")


def with_average_rank(df: DataFrame, value: str, out: str, pct: bool = True,
                      partition_by: list[str] | None = None) -> DataFrame:
    """Average-tie rank (pandas ``rank(method='average', pct=pct)``).

    With a partition key the window is distributed; without one, ranks come
    from ``global_row_number`` over (value, row id) and the tie average is a
    grouped aggregate on the value."""
    if partition_by:
        w = Window.partitionBy(*partition_by)
        first = F.rank().over(w.orderBy(F.col(value).asc_nulls_last()))
        ties = F.count(F.lit(1)).over(Window.partitionBy(*partition_by, value))
        n = F.count(F.lit(1)).over(w)
        avg = first + (ties - 1) / 2.0
        return df.withColumn(out, avg / n if pct else avg)
    tagged = df.withColumn("__rid", F.monotonically_increasing_id())
    ranked = global_row_number(tagged, [F.col(value).asc_nulls_last(), F.col("__rid")], "__rn",
                               total="__total")
    avg = ranked.groupBy(value).agg(F.avg("__rn").alias("__avg"))
    res = ranked.join(avg, [value], "left")
    val = F.col("__avg") / F.col("__total") if pct else F.col("__avg")
    return res.withColumn(out, val).drop("__rid", "__rn", "__avg", "__total")


def group_row_number(df: DataFrame, group: list[str], order: list[Column], out: str,
                     n_partitions: int | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY group ORDER BY order)`` that stays
    balanced when one group holds a large share of the rows.

    A per-group window sorts each group in one task.  Here the rows are ranked
    globally on (group, order) with range partitioning - a hot group is split
    across many partitions - and the group's first global rank (a grouped
    ``min``, combined map-side) is subtracted.  ``order`` must make
    (group, order) unique."""
    keys = [F.col(g).asc_nulls_last() for g in group] + list(order)
    ranked = global_row_number(df, keys, "__grn", n_partitions)
    first = ranked.groupBy(*group).agg(F.min("__grn").alias("__first"))
    return (ranked.join(first, group, "inner")
                  .withColumn(out, (F.col("__grn") - F.col("__first") + 1).cast("int"))
                  .drop("__grn", "__first"))


def global_prefix_sum(df: DataFrame, order: list[Column], values: list[str],
                      n_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``values`` in the global ``order`` (unique),
    without a single-partition window: range partitions are numbered and
    checkpointed as in ``global_row_number``; per-partition totals give
    offsets (one row per partition, broadcast) and a window partitioned by the
    partition id gives the running sum inside it.  Output ``cum_<value>``."""
    parts = _n_partitions(df, n_partitions)
    checkpoint_dir(df.sparkSession)
    ranged = (df.repartitionByRange(parts, *order)
                .sortWithinPartitions(*order)
                .withColumn(_PID, F.spark_partition_id())
                .withColumn(_LOCAL, F.monotonically_increasing_id()
                            - F.shiftleft(F.col(_PID).cast("long"), 33))
                .checkpoint(eager=True))
    totals = ranged.groupBy(_PID).agg(*[F.sum(v).alias(f"__t_{v}") for v in values])
    prior = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(_PID, *[F.coalesce(F.sum(f"__t_{v}").over(prior), F.lit(0)).alias(f"__o_{v}")
                                    for v in values])
    inside = Window.partitionBy(_PID).orderBy(_LOCAL).rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.select("*", *[F.sum(v).over(inside).alias(f"__w_{v}") for v in values])
    out = out.join(F.broadcast(offsets), _PID, "inner")
    return out.select(*df.columns, *[(F.col(f"__o_{v}") + F.col(f"__w_{v}")).alias(f"cum_{v}")
                                     for v in values])
