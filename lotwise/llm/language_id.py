"""Language identification by prediction by partial matching.

One byte context tree per language (``context_tree``, escape method C) is learnt from
the labelled texts and frozen; the language whose tree codes a text in the fewest bits wins.
The score is the posterior of that language under equal priors,
``1 / sum(2 ** (least - bits))``.

Learning reads all labelled rows; counts are aggregated by Spark and all kept.  A frozen model
of up to ``max_grams`` 4-grams is broadcast and scoring is a map without shuffle; of a larger
one the other 4-grams are joined (``context_tree``).

``learn_bound`` says which texts are in no learnt language: labelled texts with a checksum of 0
modulo ``FOLDS`` are coded by a model of the others.  Their rates (bits per byte in the best
language) are counted in a histogram, and the bound is ``LOOSE`` times the rate
that one in ``1 / TAIL`` of them exceeds.  A text counts as ``SPARE_BYTES`` longer, so that a few
odd bytes don't condemn a short one.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as is every
text when no labelled text exists; ``docs`` is a stored table; ties go to the first language by name; empty labelled
texts teach nothing; repeated rows count each; other columns are kept, those named as an
output are replaced.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from lotwise.llm import context_tree
from lotwise.llm.rows import fresh

UNDETERMINED = "und"
FOLDS, TAIL, LOOSE = 5, 0.001, 1.5
SPARE_BYTES, STEPS_PER_BIT = 16, 64
Model = context_tree.ContextTrees | context_tree.SplitTrees


def has_letter(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(r"\p{L}")


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
          max_grams: int = context_tree.MAX_GRAMS) -> Model | None:
    rows = labelled.select(F.col(lang_col).cast("string").alias("label"),
                           F.col(text_col).alias("text"))
    return context_tree.fit(rows.where("label is not null and text != ''"), "ppm", max_grams)


def predict(docs: DataFrame, model: Model | None,
            text_col: str = "text", lang_out: str = "lang_pred",
            score_out: str = "score", bits_out: str | None = None) -> DataFrame:
    """``docs`` with the predicted language, its score and, if named, the bits in which it
    codes the text."""
    outputs = [lang_out, score_out, *([bits_out] if bits_out else [])]
    kept = [c for c in docs.columns if c.lower() not in {x.lower() for x in outputs}]
    docs = docs.select(*[docs[f"`{c}`"] for c in kept])
    if model is None:
        return docs.withColumns({x: F.lit(0.0 if i else UNDETERMINED)
                                 for i, x in enumerate(outputs)})
    letters = has_letter(F.col(text_col))
    if isinstance(model, context_tree.SplitTrees):
        return _predict_split(docs, model, letters, text_col, outputs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    flagged = docs.withColumn(fresh(docs, "judged"), letters)
    at = [c.lower() for c in kept].index(text_col.lower())
    schema = StructType([*docs.schema.fields, StructField(lang_out, StringType()),
                         *[StructField(x, DoubleType()) for x in outputs[1:]]])

    def run(batches):
        trees = shared.value
        names = np.array(trees.labels, object)
        for batch in batches:
            judged = np.array(batch.column(len(kept)).to_pylist(), bool)
            texts = (text.as_py().encode() if ok else b""
                     for text, ok in zip(batch.column(at), judged))
            lang = np.full(len(judged), UNDETERMINED, object)
            score, coded = np.zeros(len(judged)), np.zeros(len(judged))
            bits = np.concatenate([*trees.score(texts), np.zeros((0, len(names)))])
            if len(bits):
                best = bits.argmin(axis=1)
                lead = bits - bits.min(axis=1, keepdims=True)
                lang[judged] = names[best[judged]]
                score[judged] = (1 / np.exp2(-np.minimum(lead, 1000)).sum(axis=1))[judged]
                coded[judged] = bits.min(axis=1)[judged]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array(lang.tolist(), pa.string()),
                 pa.array(score), pa.array(coded)][:len(kept) + len(outputs)],
                names=[*batch.schema.names[:len(kept)], *outputs])

    return flagged.mapInArrow(run, schema)


def _predict_split(docs: DataFrame, model: context_tree.SplitTrees, letters: Column,
                   text_col: str, outputs: list[str]) -> DataFrame:
    # Whether a text has letters is told before rows meet, so that no text need go through the join.
    bits, flag = fresh(docs, "class_bits"), fresh(docs, "has_letters")
    coded = model.with_bits(docs.withColumn(flag, letters),
                            F.when(letters, F.col(text_col)).otherwise(""), bits)
    letters = F.col(flag)
    least = F.array_min(bits)
    names = F.array(*map(F.lit, model.labels))
    lang = F.element_at(names, F.array_position(F.col(bits), least).cast("int"))
    posterior = 1 / F.aggregate(bits, F.lit(0.0), lambda total, x: total + F.pow(
        F.lit(2.0), -F.least(x - least, F.lit(1000.0))))
    return coded.select(*[F.col(f"`{c}`") for c in docs.columns], *[
        F.when(letters, value).otherwise(none).alias(name) for name, value, none in
        zip(outputs, (lang, posterior, least), (UNDETERMINED, 0.0, 0.0))])


def rate(bits: Column, text: Column) -> Column:
    """Bits per byte; a text counts as ``SPARE_BYTES`` longer."""
    return bits / (F.octet_length(text) + SPARE_BYTES)


def learn_bound(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
                max_grams: int = context_tree.MAX_GRAMS) -> float:
    """The rate beyond which a text is in no language of ``labelled``; infinite if it has no
    text with a letter to hold out, or none besides."""
    text = F.col(text_col)
    held_out = F.crc32(F.coalesce(text, F.lit(""))) % FOLDS == 0
    model = learn(labelled.where(~held_out), text_col, lang_col, max_grams)
    if model is None:
        return float("inf")
    tried = (labelled.where(held_out & F.col(lang_col).isNotNull() & has_letter(text))
             .select(text.alias("text")))
    step = F.ceil(rate(F.col("bits"), F.col("text")) * STEPS_PER_BIT)
    counts = sorted(predict(tried, model, bits_out="bits").groupBy(step.alias("step"))
                    .count().collect(), reverse=True)
    beyond, allowed = 0, TAIL * sum(n for _, n in counts)
    for at, n in counts:
        beyond += n
        if beyond > allowed:
            return LOOSE * at / STEPS_PER_BIT
    return float("inf")
