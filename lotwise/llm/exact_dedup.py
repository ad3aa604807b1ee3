"""Exact deduplication by progressive refinement (DataFrame functions only).

Texts are equal when they are identical after lower-casing A-Z.  Three passes,
each over fewer candidates:

1. byte length: lengths that only one row has are settled;
2. length and hash of the first characters, of rows with a shared length;
3. SHA-256 of the whole text, of rows whose length and prefix are shared.

A pass learns which keys are shared from an aggregate and hands them to the next
one as a bitmap of fixed size, so no text is ever shuffled and nothing that grows
with the input is broadcast.  A full bitmap only makes later passes hash more.

Groups are aggregated map-side (count and largest row), then joined back to rows of
about a hundred bytes; a group with a third of all rows is split by AQE's
skew-join handling.

Defined cases: null text counts as empty; empty texts are equal to each other; of
equal texts the largest id stays, null ids being smallest; among repeated rows with
the same id the later row stays; an empty table gives an empty result; other
columns of the input are ignored unless named in ``carry``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.rows import filter_bits as bits_for
from lotwise.llm.rows import fresh, key_bitmap, lower_ascii, may_contain, placed
from lotwise.session import checkpoint_dir

PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    return lower_ascii(F.coalesce(text, F.lit("")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                carry: dict[str, Column] | None = None, prefix_chars: int = PREFIX_CHARS,
                filter_bits: int | None = None, row_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``row_id, doc_id, keep_id, group_size, kept`` and
    the expressions of ``carry``.  ``row_id`` is the row's place (``rows.placed``), or ``row_col``.
    The filters have bits for each row unless ``filter_bits`` are given."""
    checkpoint_dir(docs.sparkSession)
    if row_col is None:
        row_col = fresh(docs, "row_id")
        docs = placed(docs, row_col)
    if filter_bits is None:
        filter_bits = bits_for(docs.count(), each=4)
    text = F.coalesce(F.col(text_col), F.lit(""))
    length = F.octet_length(text)
    prefix = F.xxhash64(lower_ascii(F.substring(text, 1, prefix_chars)))

    lengths = docs.select(length.alias("n")).groupBy("n").count().where("count > 1")
    by_length = key_bitmap(lengths, ["n"], filter_bits)

    shared_length = may_contain(by_length, [length], filter_bits)
    prefixes = (docs.where(shared_length)
                .select(length.alias("n"), prefix.alias("p"))
                .groupBy("n", "p").count().where("count > 1"))
    by_prefix = key_bitmap(prefixes, ["n", "p"], filter_bits)

    survives = shared_length & may_contain(by_prefix, [length, prefix], filter_bits)
    slim = docs.select(
        F.col(row_col).alias("row_id"), F.col(id_col).alias("doc_id"),
        F.when(survives, F.unhex(F.sha2(normalised(F.col(text_col)), 256))).alias("full_hash"),
        *[c.alias(name) for name, c in (carry or {}).items()],
    ).checkpoint()

    candidates = slim.where("full_hash is not null")
    groups = (candidates.groupBy("full_hash")
              .agg(F.count(F.lit(1)).alias("group_size"),
                   F.max(F.struct("doc_id", "row_id")).alias("top"))
              .select("full_hash", "group_size", F.col("top.doc_id").alias("keep_id"),
                      F.col("top.row_id").alias("keep_row"))
              .checkpoint())
    grouped = (candidates.join(groups, "full_hash")
               .withColumn("kept", F.col("row_id") == F.col("keep_row"))
               .drop("full_hash", "keep_row"))
    alone = (slim.where("full_hash is null").drop("full_hash")
             .withColumn("group_size", F.lit(1).cast("long"))
             .withColumn("keep_id", F.col("doc_id"))
             .withColumn("kept", F.lit(True)))
    return grouped.unionByName(alone)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the copies, all columns kept."""
    row = fresh(docs, "row_id")
    docs = placed(docs, row)
    dropped = (exact_dedup(docs, id_col, text_col, row_col=row).where(~F.col("kept"))
               .select(F.col("row_id").alias(row)))
    return docs.join(dropped, row, "left_anti").drop(row)
