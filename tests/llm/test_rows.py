"""Rows keep their identity when a table is split otherwise in a later scan."""
from __future__ import annotations

import random

import pytest

from lotwise.llm import (context_tree, decontaminate, exact_dedup, jaccard_join, language_id, near_dedup,
                         pii, rows)

PARALLELISM = "spark.sql.leafNodeDefaultParallelism"


@pytest.fixture
def many_files(spark, tmp_path):
    """Files of unequal sizes, so that another parallelism packs them into other partitions."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    table = []
    for i in range(900):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(1, 400)))
        if i % 5 == 0:
            text += f" mail user{i}@example.org or +1 (555) 010-{i:04d} now"
        table.append((i, text, "en" if i % 2 else "xx"))
    table += [(1000 + i, t, lang) for i, (_, t, lang) in enumerate(table[:200])]
    rng.shuffle(table)
    spark.createDataFrame(table, "doc_id long, text string, lang string").repartition(
        30).write.parquet(f"{tmp_path}/docs")
    yield f"{tmp_path}/docs"
    spark.conf.unset(PARALLELISM)


class Shifting:
    """A session's parallelism changes with every checkpoint, as if executors came and went."""

    def __init__(self, spark, monkeypatch):
        from pyspark.sql.classic.dataframe import DataFrame

        self.turn, plain = 0, DataFrame.checkpoint

        def checkpoint(df, *args, **kwargs):
            done = plain(df, *args, **kwargs)
            self.turn += 1
            spark.conf.set(PARALLELISM, str((3, 24, 16)[self.turn % 3]))
            return done

        monkeypatch.setattr(DataFrame, "checkpoint", checkpoint)


OPERATORS = {
    "exact_dedup": lambda spark, docs: exact_dedup.exact_dedup(docs).drop("row_id"),
    "drop_copies": lambda spark, docs: exact_dedup.drop_copies(docs),
    "near_dedup": lambda spark, docs: near_dedup.near_dedup(docs).drop("row_id"),
    "jaccard_join": lambda spark, docs: jaccard_join.jaccard_join(docs),
    "drop_near_copies": lambda spark, docs: near_dedup.drop_near_copies(docs),
    "pii": lambda spark, docs: pii.find_pii(docs).drop("row_id"),
    "decontaminate": lambda spark, docs: decontaminate.drop_contaminated(
        docs, docs.where("doc_id < 40").selectExpr("doc_id as item_id", "text")),
    "language_id": lambda spark, docs: language_id.predict(
        docs, language_id.learn(docs.where("doc_id < 300"), max_grams=64)).drop("score"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_results_don_t_depend_on_how_scans_are_split(spark, many_files, monkeypatch, name):
    def result():
        docs = spark.read.parquet(many_files)
        return sorted(map(repr, OPERATORS[name](spark, docs).collect()))

    spark.conf.unset(PARALLELISM)
    expected = result()
    Shifting(spark, monkeypatch)
    assert result() == expected


def test_places_are_stored_ones(spark, many_files):
    def places(parallelism, df):
        spark.conf.set(PARALLELISM, str(parallelism))
        return {r["doc_id"]: tuple(r["p"]) for r in rows.placed(df, "p").collect()}

    docs = spark.read.parquet(many_files).where("doc_id >= 0").select("doc_id", "text")
    assert places(24, docs) == places(3, docs) and len(set(places(3, docs).values())) == 1100
    joined = docs.join(spark.range(2).withColumnRenamed("id", "k"), docs.doc_id % 2 == 0)
    assert len({tuple(r["p"]) for r in rows.placed(joined, "p").collect()}) == joined.count()
    assert rows.placed(docs.limit(0), "p").count() == 0


def test_filters_grow_with_their_keys():
    assert rows.filter_bits(10) == 1 << 16 and rows.filter_bits(10 ** 6) == 1 << 24
    assert rows.filter_bits(10 ** 9) == 1 << 26
    assert context_tree.MAX_GRAMS == 1 << 20
