"""Helpers that several operators of this package use."""
from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(col: Column) -> Column:
    """A-Z lower-cased, every other character untouched."""
    return F.translate(col, UPPER, UPPER.lower())


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def _is_file_scan(docs: DataFrame) -> bool:
    """Each row of ``docs`` is one row of a Parquet file."""
    plan = docs._jdf.queryExecution().analyzed()
    while plan.children().size() == 1 and plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return (plan.nodeName() == "LogicalRelation" or plan.nodeName().startswith("Relation")) and (
        "parquet" in plan.simpleString(25).lower())


def placed(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a column that tells its rows apart and is the same in every scan: a struct of the hash of
    the row's Parquet file and its place in that file.  How a scan is split, which depends
    on the executors at hand, doesn't matter to it.  What isn't a plain scan of Parquet files
    is written to the shared folder and read from there."""
    if not _is_file_scan(docs):
        path = os.path.join(checkpoint_dir(docs.sparkSession), f"rows-{uuid.uuid4().hex}")
        docs.write.parquet(path)
        docs = docs.sparkSession.read.schema(docs.schema).parquet(path)
    return docs.select("*", F.struct(F.xxhash64("_metadata.file_path").alias("file"),
                                     F.col("_metadata.row_index").alias("row")).alias(name))


def filter_bits(keys: int, each: int = 16, most: int = 1 << 26) -> int:
    """Bits of a filter for so many keys: a power of two, ``most`` (8 MB) at the most; beyond that it lets more
    rows pass, and loses none."""
    return min(most, 1 << max(16, (each * keys - 1).bit_length()))


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _slot(keys: list[Column], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits))


def key_bitmap(keys: DataFrame, columns: list[str], bits: int) -> Column:
    """One-hash Bloom filter of the rows of ``keys`` as a scalar subquery.

    It is an array of ``bits / 64`` longs whatever the number of keys: words are
    or-ed together in an aggregate, so tasks and driver see ``bits / 64`` rows.
    A fuller filter lets more rows pass ``may_contain``; it never loses one.
    """
    slot = _slot([F.col(c) for c in columns], bits)
    words = keys.select((slot / 64).cast("int").alias("word"),
                        F.expr("1L").alias("one"), (slot % 64).cast("int").alias("bit"))
    words = words.select("word", F.expr("shiftleft(one, bit)").alias("mask"))
    blank = keys.sparkSession.range(bits // 64).select(
        F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("mask"))
    dense = words.unionByName(blank).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    packed = F.transform(F.sort_array(F.collect_list(F.struct("word", "mask"))),
                         lambda x: x["mask"])
    return dense.agg(packed.alias("bitmap")).scalar()


def may_contain(bitmap: Column, keys: list[Column], bits: int) -> Column:
    slot = _slot(keys, bits)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))
    return F.get(bitmap, (slot / 64).cast("int")).bitwiseAND(bit) != 0
