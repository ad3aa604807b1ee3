"""Balanced contiguous shards from global prefix sums (DataFrame functions only).

Rows are range-partitioned in id order; each partition sums its bytes and counts
its rows; prefix sums over those totals (one row per partition) give every partition
its global offset, and a running sum inside the partition completes it.  The byte line is
cut at equal targets: a row belongs to the shard in which the middle of its bytes lies.

The order is (id, checksum, row number of the scan), which is unique, so a
repeated id with a third of all rows is spread over several range partitions.  Only the
narrow columns are sorted.  The range partitions are checkpointed once, as bounds come from
a sample.  Broadcast: one row per partition, and one per shard.

Defined cases: null text has no bytes (a size of 8); null ids come first; an empty table
gives no rows; a text larger than a target may leave a shard empty; other columns
are ignored.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.rows import shuffle_partitions
from lotwise.session import checkpoint_dir

ROW_OVERHEAD = 8


def byte_shards(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id",
                text_col: str = "text", row_overhead: int = ROW_OVERHEAD,
                partitions: int | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for each row of ``docs``; ``slot`` numbers
    the rows of a shard from 0 in order."""
    checkpoint_dir(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    order = ["doc_id", "text_crc32", "row_id"]
    ranged = (docs.select(F.col(id_col).alias("doc_id"),
                          (F.octet_length(text) + row_overhead).cast("long").alias("size"),
                          F.crc32(text).alias("text_crc32"),
                          F.monotonically_increasing_id().alias("row_id"))
              .repartitionByRange(partitions or shuffle_partitions(docs), *order)
              .withColumn("part", F.spark_partition_id())
              .checkpoint())

    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"))

    inside = Window.partitionBy("part").orderBy(*order)
    placed = (ranged
              .withColumn("through", F.sum("size").over(
                  inside.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("nth", F.row_number().over(inside))
              .join(F.broadcast(offsets), "part")
              .withColumn("doubled_middle",
                          2 * (F.col("bytes_before") + F.col("through")) - F.col("size"))
              .withColumn("shard", F.least(
                  F.expr(f"doubled_middle * {n_shards}L div (2 * all_bytes)"),
                  F.lit(n_shards - 1)).cast("int"))
              .withColumn("position", F.col("rows_before") + F.col("nth")))
    starts = placed.groupBy("shard").agg(F.min("position").alias("shard_start"))
    return (placed.join(F.broadcast(starts), "shard")
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("position") - F.col("shard_start")).cast("long").alias("slot")))
