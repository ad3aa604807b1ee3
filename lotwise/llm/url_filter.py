"""URL filters by a ratio of character language models.

Rules decide the URLs they fit.  All those URLs, accepted and rejected, teach two
smoothed variable-order Markov models (``context_tree`` with absolute discounting) over
the characters of host and path.  Any other URL is judged by the difference of its
log-likelihoods per byte, ``(rejected bits - accepted bits) / bytes``.

Calibration: URLs with a checksum of 0 modulo ``folds`` teach nothing; they are scored
by a model of the rest, their differences are counted in a histogram of fixed width, and the
threshold that gives accepted and rejected URLs the same error rate (the mean of the two
is least) is taken.  The final models learn from all decided URLs.

Counts are aggregated by Spark and all kept; what is broadcast of the models and the
histogram have fixed bounds.

Rules are few (a parameter list); a rule fits its host and all subdomains if the path
starts with the rule's, and the longest one wins.

Defined cases: a null URL or one without ``://`` has an empty host and path, and as a URL
without bytes a difference of 0; a difference on the threshold allows; without accepted or
rejected URLs to learn from, undecided ones are allowed; repeated rows count
each; an empty table gives no rows; other columns are kept, those named as an output are
replaced.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lotwise.llm import context_tree
from lotwise.llm.rows import fresh, lower_ascii

ALLOW, BLOCK = "allow", "block"
FOLDS = 5
BINS_PER_BIT, WIDEST_BITS = 64, 16
OUTPUTS = ("host", "path", "rule", "url_score", "verdict")


@dataclass(frozen=True)
class Rule:
    """``text`` is a host and the start of a path, like ``example.org/fr/``."""
    verdict: str
    text: str

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, rest = self.text.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return (lower_ascii(F.regexp_extract(url, pattern, 1)), F.regexp_extract(url, pattern, 2))


def apply_rules(rules: list[Rule], host: Column, path: Column) -> Column:
    """A struct (rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        mine = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        out = F.when(rule.fits(host, path), mine).otherwise(out)
    return out


@dataclass
class UrlModel:
    trees: context_tree.ContextTrees | context_tree.SplitTrees | None
    threshold: float


def _differences(trees: context_tree.ContextTrees, texts: list[str]) -> np.ndarray:
    coded = [t.encode() for t in texts]
    bits = np.concatenate([*trees.score(coded), np.zeros((0, 2))])
    lengths = np.fromiter(map(len, coded), float, len(coded))
    accepted, rejected = (bits[:, trees.labels.index(x)] for x in (ALLOW, BLOCK))
    return (rejected - accepted) / np.maximum(lengths, 1)


def score(urls: DataFrame, trees: context_tree.ContextTrees | context_tree.SplitTrees,
          text_col: str, out_col: str) -> DataFrame:
    if isinstance(trees, context_tree.SplitTrees):
        bits = fresh(urls, "bits")
        accepted, rejected = (F.col(bits)[trees.labels.index(x)] for x in (ALLOW, BLOCK))
        n_bytes = F.greatest(F.octet_length(text_col), F.lit(1))
        return (trees.with_bits(urls, F.col(text_col), bits)
                .withColumn(out_col, (rejected - accepted) / n_bytes).drop(bits))
    shared = urls.sparkSession.sparkContext.broadcast(trees)
    at = urls.columns.index(text_col)
    schema = StructType([*urls.schema.fields, StructField(out_col, DoubleType())])

    def run(batches):
        for batch in batches:
            values = _differences(shared.value, batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)],
                                             names=[*batch.schema.names, out_col])

    return urls.mapInArrow(run, schema)


def learn(urls: DataFrame, rules: list[Rule], url_col: str = "url", folds: int = FOLDS,
          max_grams: int = context_tree.MAX_GRAMS) -> UrlModel:
    host, path = url_parts(F.col(url_col))
    decided = (urls.select(host.alias("host"), path.alias("path"))
               .withColumn("label", apply_rules(rules, F.col("host"), F.col("path"))["verdict"])
               .select("label", F.concat("host", "path").alias("text"))
               .where("label is not null and text != ''"))
    held_out = F.crc32("text") % folds == 0
    trees = context_tree.fit(decided, "discount", max_grams)
    if trees is None or len(trees.labels) < 2:
        return UrlModel(None, 0.0)
    inner = context_tree.fit(decided.where(~held_out), "discount", max_grams)
    if inner is None or len(inner.labels) < 2:
        return UrlModel(trees, 0.0)
    bound = WIDEST_BITS * BINS_PER_BIT
    step = F.greatest(F.lit(-bound), F.least(F.lit(bound), F.floor(F.col("d") * BINS_PER_BIT)))
    histogram = (score(decided.where(held_out), inner, "text", "d")
                 .groupBy("label", step.cast("int").alias("step")).count().collect())
    return UrlModel(trees, equal_error_threshold(
        [(r["label"], r["step"], r["count"]) for r in histogram]))


def equal_error_threshold(histogram: list[tuple[str, int, int]]) -> float:
    """The bin edge with the least mean of both classes' error rates; of equal ones the
    nearest to 0."""
    steps = sorted({edge for _, s, _ in histogram for edge in (s, s + 1)})
    steps += [(a + b) // 2 for a, b in zip(steps, steps[1:])]
    total = {x: sum(n for label, _, n in histogram if label == x) for x in (ALLOW, BLOCK)}
    if not all(total.values()):
        return 0.0

    def error(edge: int) -> float:
        lost = sum(n for label, s, n in histogram if label == ALLOW and s < edge)
        let_in = sum(n for label, s, n in histogram if label == BLOCK and s >= edge)
        return lost / total[ALLOW] + let_in / total[BLOCK]

    return min(steps, key=lambda edge: (error(edge), abs(edge))) / BINS_PER_BIT


def judge(urls: DataFrame, rules: list[Rule], model: UrlModel,
          url_col: str = "url") -> DataFrame:
    """``urls`` with ``host, path, rule, url_score, verdict``."""
    kept = [c for c in urls.columns if c.lower() not in OUTPUTS]
    host, path = url_parts(F.col(url_col))
    decided, judged = fresh(urls, "decided"), fresh(urls, "judged")
    out = (urls.select(*[F.col(f"`{c}`") for c in kept], host.alias("host"), path.alias("path"))
           .withColumn(decided, apply_rules(rules, F.col("host"), F.col("path")))
           .select(*[F.col(f"`{c}`") for c in kept], "host", "path",
                   F.col(decided)["rule"].alias("rule"),
                   F.col(decided)["verdict"].alias("verdict"),
                   F.concat("host", "path").alias(judged)))
    if model.trees is None:
        out = out.withColumn("url_score", F.lit(0.0))
    else:
        out = score(out, model.trees, judged, "url_score")
    by_model = F.when(F.col("url_score") >= model.threshold, ALLOW).otherwise(BLOCK)
    return (out.drop(judged)
            .withColumn("verdict", F.coalesce("verdict", by_model)))
