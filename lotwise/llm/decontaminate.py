"""Benchmark decontamination by winnowing.

Texts are sequences of words (A-Z lower-cased).  Documents and benchmark items keep, of
every window of ``window - k + 1`` consecutive word ``k``-grams, those with the
least hash.  A span of ``window`` words that both share holds one such window of
k-grams on either side, so both keep the same fingerprint inside it: no shared span of that
length is missed.  Fingerprints are joined, and each hit is extended word by word to
both sides; ``window`` equal words in a row make the words hits.  An item of fewer words
is one window: its length gets k-grams of that length, all kept.

Documents are read once.  A bitmap of the benchmark's fingerprints, of fixed size whatever
the benchmark's, lets only likely fingerprints leave a task, with the words around them
(as hashes of 64 bits) for the extension.  The join is an ordinary one that Spark broadcasts or
shuffles by size; a fingerprint that very many documents share is a skewed key there,
which AQE splits.  What is grouped per document is that document's hits.

Defined cases: null and empty texts have no words and no hits; an item without words never
occurs; items with the same id are one item; a null item id is the empty string; an empty
benchmark leaves all documents clean; repeated documents are judged each; other columns are
ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from lotwise.llm import shingles
from lotwise.llm.rows import fresh, placed
from lotwise.session import checkpoint_dir

WINDOW, GRAM = 13, 5
FILTER_BITS = 1 << 22
MIN_SHARE = 20  # contaminated: at least one of so many words is a hit

WORD = shingles.byte_class(lambda b: b >= 0x80 or chr(b).isdigit() or chr(b).islower())

_CANDIDATES = "array<struct<span:int, gram:long, pos:int, around:binary>>"


def _shifted(x: np.ndarray, width: int, f) -> np.ndarray:
    """``f`` over each run of ``width`` values, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = f(x[:len(x) - step], x[step:])
        done += step
    return x


def _fits(owner: np.ndarray, length: int) -> np.ndarray:
    """Whether ``length`` words from each position are of one text."""
    return owner[:len(owner) - length + 1] == owner[length - 1:]


def winnow(hashes: np.ndarray, owner: np.ndarray, k: int, window: int) -> tuple:
    """Positions and hashes of the fingerprints: k-grams that are least in a window."""
    gram = shingles.grams(hashes, k)
    if len(hashes) < window:
        return np.zeros(0, np.int64), gram[:0]
    run = window - k + 1
    least = _shifted(gram, run, np.minimum)
    least = np.where(_fits(owner, window), least, np.uint64(0))  # no window crosses texts
    padded = np.concatenate([np.zeros(run - 1, np.uint64), least, np.zeros(run - 1, np.uint64)])
    at = np.flatnonzero(_shifted(padded, run, np.maximum) == gram)
    return at, gram[at]


def _around(hashes: np.ndarray, bounds: np.ndarray, text: np.ndarray, at: np.ndarray,
            k: int, window: int) -> np.ndarray:
    """Hashes of the words that a window over the gram can reach; 0 outside the text."""
    reach = at[:, None] + np.arange(k - window, window)
    inside = (reach >= bounds[text][:, None]) & (reach < bounds[text + 1][:, None])
    return np.where(inside, hashes[np.clip(reach, 0, len(hashes) - 1)], np.uint64(0))


def _fingerprints(table: DataFrame, id_col: str, text_col: str, window: int, k: int,
                  short: list[int] | None, bitmap: np.ndarray | None, row_col: str) -> DataFrame:
    """``row_id, id, n_words, candidates`` for each row of ``table``: its fingerprints that
    pass the bitmap.  ``short``: the lengths of short items to look for; None for items,
    which have those of their own length."""
    slim = table.select(F.col(row_col).alias("row_id"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = (StructType([*slim.schema.fields[:2]]).add("n_words", "long")
              .add("candidates", DataType.fromDDL(_CANDIDATES)))
    shared = table.sparkSession.sparkContext.broadcast(bitmap)

    def kinds(lengths: np.ndarray):
        yield k, window
        wanted = short if short is not None else np.unique(lengths[lengths < window]).tolist()
        yield from ((n, n) for n in wanted if n)

    def rows_of(block: list[bytes]):
        hashes, bounds = shingles.words(block, WORD)
        lengths = np.diff(bounds)
        owner = np.repeat(np.arange(len(block)), lengths)
        found: list[list] = [[] for _ in block]
        for size, span in kinds(lengths):
            at, gram = winnow(hashes, owner, size, span)
            if short is None and size == span:  # of items, only those of this length
                own = lengths[owner[at]] == span
                at, gram = at[own], gram[own]
            if shared.value is not None and len(at):
                slot = gram % np.uint64(len(shared.value) * 64)
                hit = (shared.value[(slot >> np.uint64(6)).astype(np.int64)]
                       >> (slot & np.uint64(63))) & np.uint64(1)
                at, gram = at[hit == 1], gram[hit == 1]
            if not len(at):
                continue
            around = _around(hashes, bounds, owner[at], at, size, span)
            for i, text in enumerate(owner[at].tolist()):
                found[text].append({"span": span, "gram": int(gram[i].view(np.int64)),
                                    "pos": int(at[i] - bounds[text]),
                                    "around": around[i].tobytes()})
        return lengths.tolist(), found

    kind = pa.list_(pa.struct([("span", pa.int32()), ("gram", pa.int64()), ("pos", pa.int32()),
                               ("around", pa.binary())]))

    def run(batches):
        for batch in batches:
            counts, found = [], []
            texts = ((t.as_py() or "").encode() for t in batch.column(2))
            for block in shingles.text_blocks(texts):
                n, rows = rows_of(block)
                counts += n
                found += rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()),
                 pa.array(found, kind)], names=["row_id", "id", "n_words", "candidates"])

    return slim.mapInArrow(run, schema)


def _bitmap(prints: DataFrame, bits: int) -> np.ndarray:
    """At most ``bits / 64`` rows reach the driver."""
    # The slot is the unsigned hash modulo a power of two: its low bits.
    slot = F.col("gram").bitwiseAND(F.lit(bits - 1))
    words = prints.select(F.shiftrightunsigned(slot, 6).cast("int").alias("word"),
                          F.call_function("shiftleft", F.lit(1).cast("long"),
                                          slot.bitwiseAND(F.lit(63)).cast("int")).alias("mask"))
    table = words.groupBy("word").agg(F.bit_or("mask").alias("mask")).collect()
    out = np.zeros(bits // 64, np.int64)
    for row in table:
        out[row["word"]] = row["mask"]
    return out.view(np.uint64)


def _extend(pairs: DataFrame, window: int, k: int) -> DataFrame:
    """``row_id, item_id, start, end`` of hits of whole windows.  ``a`` and ``b`` are the
    words around the fingerprint in the document and in the item."""
    def run(batches):
        for batch in batches:
            spans = batch.column("span").to_numpy()
            for span in np.unique(spans).tolist():
                part = batch.take(pa.array(np.flatnonzero(spans == span)))
                size = k if span == window else span
                left = span - size
                a, b = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint64)
                        .reshape(part.num_rows, -1) for c in ("a", "b"))
                same = (a == b) & (a != 0)
                before = np.cumprod(same[:, :left][:, ::-1], axis=1).sum(axis=1)
                after = np.cumprod(same[:, left + size:], axis=1).sum(axis=1)
                core = same[:, left:left + size].all(axis=1)
                hit = pa.array(core & (before + size + after >= span))
                start = part.column("pos").to_numpy() - before
                ends = pa.array((start + before + size + after).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row_id").filter(hit), part.column("item_id").filter(hit),
                     pa.array(start.astype(np.int32)).filter(hit), ends.filter(hit)],
                    names=["row_id", "item_id", "start", "end"])

    schema = (StructType([pairs.schema["row_id"]]).add("item_id", "string")
              .add("start", "integer").add("end", "integer"))
    return pairs.mapInArrow(run, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, k: int = GRAM,
                  filter_bits: int = FILTER_BITS, row_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``row_id, doc_id, n_words, n_hit, item_ids`` (sorted
    strings), ``spans`` (merged hit spans, as word positions) and ``contaminated``.
    ``row_id`` is the row's place (``rows.placed``), or ``row_col``."""
    checkpoint_dir(docs.sparkSession)
    if row_col is None:
        row_col = fresh(docs, "row_id")
        docs = placed(docs, row_col)
    named = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit(""))
                             .alias("item_id"), F.col(item_text_col).alias("text"))
    items = _fingerprints(named, "item_id", "text", window, k, None, None, "item_id").checkpoint()
    prints = (items.select(F.col("id").alias("item_id"), F.explode("candidates").alias("c"))
              .select("item_id", "c.span", "c.gram", F.col("c.around").alias("b")).distinct())
    short = [r["n_words"] for r in items.where(F.col("n_words").between(1, window - 1))
             .select("n_words").distinct().collect()]
    judged = _fingerprints(docs, id_col, text_col, window, k, sorted(short),
                           _bitmap(prints, filter_bits), row_col).checkpoint()

    candidates = (judged.select("row_id", F.explode("candidates").alias("c"))
                  .select("row_id", "c.span", "c.gram", "c.pos", F.col("c.around").alias("a")))
    hits = _extend(candidates.join(prints, ["span", "gram"]), window, k).checkpoint()

    before = (Window.partitionBy("row_id").orderBy("start", "end")
              .rowsBetween(Window.unboundedPreceding, -1))
    runs = (hits.select("row_id", "start", "end").distinct()
            .withColumn("reached", F.coalesce(F.max("end").over(before), F.lit(0)))
            .withColumn("fresh", F.greatest(F.lit(0), F.col("end")
                                            - F.greatest("start", "reached"))))
    covered = runs.groupBy("row_id").agg(
        F.sum("fresh").alias("n_hit"),
        F.sort_array(F.collect_list(F.when(F.col("fresh") > 0, F.struct(
            F.greatest("start", "reached").alias("start"), "end")))).alias("spans"))
    occurring = (hits.select("row_id", "item_id").distinct().groupBy("row_id")
                 .agg(F.sort_array(F.collect_list("item_id")).alias("item_ids")))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return (judged.select("row_id", F.col("id").alias("doc_id"), "n_words")
            .join(covered.join(occurring, "row_id"), "row_id", "left")
            .select("row_id", "doc_id", "n_words", n_hit.alias("n_hit"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
                    F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>"))
                    .alias("spans"),
                    ((n_hit > 0) & (n_hit * MIN_SHARE >= F.col("n_words"))).alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated ones, all columns kept."""
    row = fresh(docs, "row_id")
    docs = placed(docs, row)
    dropped = (decontaminate(docs, benchmark, row_col=row, **options).where("contaminated")
               .select(F.col("row_id").alias(row)))
    return docs.join(dropped, row, "left_anti").drop(row)
