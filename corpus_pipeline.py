"""Corpus pipeline: a training corpus from ``documents``, in five stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``.  ``docs`` is a stored table (the
result of the stage before, written as Parquet and reread).  All but the last stage return the
columns of ``documents``; what a stage drops stays dropped.

1. language ID: documents without a letter go, and those that the model codes worse than
   any learnt language allows (without labelled documents only the former);
2. exact dedup: of equal texts one document stays;
3. near dedup: of near-duplicate components one document stays;
4. benchmark decontamination: contaminated documents go;
5. SentencePiece encoding: piece ids of what is left, checked by decoding.
"""
from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import (decontaminate, exact_dedup, language_id, near_dedup,
                         sentencepiece_unigram)
from lotwise.llm.rows import fresh
from lotwise.session import checkpoint_dir

PIECE_FILE = "piece_bpe_32k.model"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.learn(docs)
    if model is None:
        return docs.where(language_id.has_letter(F.col("text")))
    lang, score, bits = (fresh(docs, name) for name in ("said_lang", "said_score", "said_bits"))
    judged = language_id.predict(docs, model, lang_out=lang, score_out=score, bits_out=bits)
    fits = (language_id.rate(F.col(bits), F.col("text"))
            <= F.lit(language_id.learn_bound(docs)))
    return (judged.where((F.col(lang) != language_id.UNDETERMINED) & fits)
            .select(*[judged[f"`{c}`"] for c in docs.columns]))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = sentencepiece_unigram.Pieces.from_file(public_tokenizers.path(PIECE_FILE))
    coded = sentencepiece_unigram.encode(docs.select("doc_id", "lang", "source", "text"), pieces,
                                         decoded_col="decoded")
    same = F.col("decoded") == F.translate("text", sentencepiece_unigram.MARKER, " ")
    return coded.select("doc_id", "lang", "source", "piece_ids",
                        F.size("piece_ids").cast("long").alias("n_pieces"),
                        same.alias("round_trip"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", decontaminate_benchmark),
    ("sentencepiece", encode_pieces),
]

#: Trained models and similarity joins have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; results of stages go to the shared folder."""
    folder = os.path.join(checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
