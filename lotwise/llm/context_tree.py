"""Variable-order byte context trees for several classes, with frozen statistics.

Counting is a Spark aggregation: tasks count the byte 4-grams of their texts per class
(a text starts with three zero bytes), partial counts are summed by a shuffle.  No count is
dropped.  Up to ``max_grams`` distinct (class, 4-gram) pairs the model is one ``ContextTrees``
on the driver, which is broadcast.  Beyond that it is a ``SplitTrees``: the counts stay a stored
table, dealt by the two middle bytes of a 4-gram, on which all its contexts of order 1 to 3
and their codes depend; orders 0 and 1 and the code lengths of the most frequent 4-grams
are broadcast, the other 4-grams of the texts meet theirs in a join.  Both code alike.

In each class's tree a context of ``k`` bytes (0 to 3) has ``n`` followers, ``d`` of
them distinct.  Seen bytes share the part of the probability that isn't kept for
escape; the escape part goes to the bytes not seen here, in proportion to the next shorter
context, so the code of each context is exactly normalised:

* ``ppm``: method C, a byte seen ``c`` times has ``c / (n + d)`` and escape ``d / (n + d)``;
* ``discount``: absolute discounting, ``(c - D) / n`` and escape ``D * d / n``.

Scoring looks up a byte's whole 4-gram, else escapes to shorter contexts; all
classes are scored at once with numpy.
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lotwise.llm.rows import fresh, placed
from lotwise.session import checkpoint_dir

ORDER = 3
MAX_GRAMS = 1 << 20  # (class, 4-gram) pairs that are broadcast; the others are joined
PART_GRAMS = 1 << 16  # about so many of them make a part of a larger model
DISCOUNT = 0.75
BLOCK_BYTES = 1 << 20
_MASKS = [0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF]


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The 4-grams that end at each byte of each text, and the texts' ends among them."""
    pad = bytes(ORDER)
    flat = np.frombuffer(b"".join([x for t in texts for x in (pad, t)]) or pad, np.uint8)
    wide = flat.astype(np.uint32)
    codes = (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(lengths + ORDER) - lengths - ORDER
    keep = np.ones(len(codes), bool)
    for i in range(1, ORDER + 1):  # codes that end in the pad of the next text
        at = starts[1:] - i
        keep[at[at >= 0]] = False
    return codes[keep], np.cumsum(lengths)


def _blocks(rows: Iterable[tuple]) -> Iterator[list[tuple]]:
    block, size = [], 0
    for row in rows:
        block.append(row)
        size += len(row[-1])
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def count_grams(texts: DataFrame) -> DataFrame:
    """``label, gram, n`` from ``label, text`` (both not null)."""
    def run(batches):
        for batch in batches:
            labels, values = batch.column(0).to_pylist(), batch.column(1)
            rows = ((label, v.as_py().encode()) for label, v in zip(labels, values))
            for block in _blocks(rows):
                by_label: dict[str, list[bytes]] = {}
                for label, text in block:
                    by_label.setdefault(label, []).append(text)
                for label, own in by_label.items():
                    found, n = np.unique(grams(own)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([label] * len(found)), pa.array(found.astype(np.int64)),
                         pa.array(n.astype(np.int64))], names=["label", "gram", "n"])

    counted = texts.select("label", "text").mapInArrow(run, "label string, gram long, n long")
    return counted.groupBy("label", "gram").agg(F.sum("n").alias("n"))


def fit(texts: DataFrame, kind: str = "ppm",
        max_grams: int = MAX_GRAMS) -> ContextTrees | SplitTrees | None:
    """Trees of all classes of ``label, text``; None without rows.  ``max_grams`` bounds what
    is broadcast, not the counts."""
    counts = count_grams(texts).persist()
    try:
        sizes = counts.groupBy("label").count().collect()
        if not sizes:
            return None
        total = sum(r["count"] for r in sizes)
        if total > max_grams:
            return SplitTrees(counts, total, kind, max_grams)
        return ContextTrees(*_columns(counts), kind)
    finally:
        counts.unpersist()


def _columns(counts: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    table = counts.select("label", "gram", "n").orderBy("label", "gram").toArrow()
    return (table["label"].to_pylist(), table["gram"].to_numpy().astype(np.uint32),
            table["n"].to_numpy())


class HashIndex:
    """Positions of distinct 32-bit keys by open addressing, for many lookups at once."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.keys = keys
        slot, left = self._slot(keys), np.arange(len(keys), dtype=np.int32)
        while len(left):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = left[free]
            lost = self.slots[slot] != left
            slot, left = (slot[lost] + 1) & ((1 << self.bits) - 1), left[lost]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = (keys ^ (keys >> np.uint32(15))) * np.uint32(0x9E3779B1)
        return (mixed >> np.uint32(32 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Positions, -1 where a key is absent."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        slot = self._slot(keys)
        out = self.slots[slot]
        open_ = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            out[open_] = self.slots[slot[open_]]
            at = out[open_]
            open_ = open_[(at >= 0) & (self.keys[at] != keys[open_])]
        return out


class ContextTrees:
    """Code lengths in bits under each class's tree."""

    def __init__(self, labels: list[str], codes: np.ndarray, counts: np.ndarray,
                 kind: str = "ppm", order: int = ORDER, lower: ContextTrees | None = None):
        """Orders up to ``order``; ``lower`` has orders 0 and 1 for all classes, if they
        are not to be counted here."""
        self.order = order
        self.labels = lower.labels if lower else sorted(set(labels))
        number = {x: i for i, x in enumerate(self.labels)}
        owner = np.array([number[x] for x in labels], int)
        # By order: sorted grams and contexts of any class.
        self.keys = lower.keys[:2] if lower else []
        self.contexts = lower.contexts[:2] if lower else []
        first = len(self.keys)
        for k in range(first, order + 1):
            self.keys.append(np.unique(codes & np.uint32(_MASKS[k])))
            self.contexts.append(np.unique(self.keys[k] >> np.uint32(8)))
        width = len(self.labels)
        self.bits = [np.zeros((len(x) if k >= first else 0, width), np.float32)
                     for k, x in enumerate(self.keys)]
        self.escape = [np.zeros((len(x) if k >= first else 0, width), np.float32)
                       for k, x in enumerate(self.contexts)]
        self.below = []  # by class: probabilities of the grams of order 1, if none is higher
        for c in range(width):
            self._grow(c, codes[owner == c], counts[owner == c].astype(float), kind, first,
                       lower.below[c] if lower else None)
        if lower:
            self.two_bytes = lower.two_bytes
        else:
            self._dense()
        self.gram_index, self.context_index = ([None, None, *map(HashIndex, x[2:])]
                                               for x in (self.keys, self.contexts))

    def _grow(self, c: int, codes: np.ndarray, counts: np.ndarray, kind: str, first: int,
              below: np.ndarray | None) -> None:
        """``below``: probabilities under the next shorter context, for all its grams."""
        for k in range(first, self.order + 1):
            own, at = np.unique(codes & np.uint32(_MASKS[k]), return_inverse=True)
            seen = np.bincount(at, counts)
            contexts, of = np.unique(own >> np.uint32(8), return_inverse=True)
            n, d = np.bincount(of, seen), np.bincount(of).astype(float)
            if kind == "ppm":
                p, out = seen / (n + d)[of], d / (n + d)
            else:
                p, out = (seen - DISCOUNT) / n[of], DISCOUNT * d / n
            if k == 0:
                shorter, lower = np.full(len(own), 1 / 256), np.full(len(self.keys[0]), 1 / 256)
            else:
                lower = below[np.searchsorted(self.keys[k - 1], self.keys[k]
                                              & np.uint32(_MASKS[k - 1]))]
                shorter = lower[np.searchsorted(self.keys[k], own)]
            rest = np.maximum(1 - np.bincount(of, shorter), 1e-9)
            full = rest <= 1e-9  # no byte is left to escape to
            weight = np.where(full, 1.0, out / rest)
            # All grams of any class: escape, then overwrite what this class has seen.
            where = np.searchsorted(contexts, self.keys[k] >> np.uint32(8))
            where[where == len(contexts)] = 0
            value = lower.copy()
            if len(contexts):
                known = contexts[where] == self.keys[k] >> np.uint32(8)
                value *= np.where(known, weight[where], 1.0)
            value[np.searchsorted(self.keys[k], own)] = p
            self.bits[k][:, c] = -np.log2(np.maximum(value, 1e-30))
            self.escape[k][np.searchsorted(self.contexts[k], contexts), c] = -np.log2(weight)
            below = value
        if self.order == 1:
            self.below.append(below)

    def _dense(self) -> None:
        """Orders 0 and 1 as full tables; hash indices for the others."""
        width = len(self.labels)
        zero = np.tile(self.escape[0][0] + 8.0, (256, 1)).astype(np.float32)
        zero[self.keys[0]] = self.bits[0]
        one = np.tile(zero, (256, 1)).reshape(256, 256, width)
        one[self.contexts[1]] += self.escape[1][:, None, :]
        self.two_bytes = one.reshape(65536, width)
        self.two_bytes[self.keys[1]] = self.bits[1]

    def code_lengths(self, codes: np.ndarray, k: int = ORDER) -> np.ndarray:
        """Bits of each byte, given as 4-gram codes, under each class."""
        if k == 1:
            return self.two_bytes[codes]
        at = self.gram_index[k].find(codes)
        out = (self.bits[k][at] if len(self.bits[k])
               else np.zeros((len(codes), len(self.labels)), np.float32))
        absent = np.flatnonzero(at < 0)
        if len(absent):
            missing = codes[absent]
            value = self.code_lengths(missing & np.uint32(_MASKS[k - 1]), k - 1)
            context = self.context_index[k].find(missing >> np.uint32(8))
            known = context >= 0
            value[known] += self.escape[k][context[known]]
            out[absent] = value
        return out

    def score(self, texts: Iterable[bytes]) -> Iterator[np.ndarray]:
        """Arrays (texts, classes) of total bits, by blocks of consecutive texts."""
        for block in _blocks((t,) for t in texts):
            codes, ends = grams([t for t, in block])
            total = np.zeros((len(ends) + 1, len(self.labels)))
            lengths = np.diff(ends, prepend=0)
            if len(codes):
                filled = np.flatnonzero(lengths)
                total[filled] = np.add.reduceat(self.code_lengths(codes),
                                                (ends - lengths)[filled], axis=0, dtype=float)
            yield total[:len(ends)]


class SplitTrees:
    """Trees whose counts are a stored table; ``labels`` as in ``ContextTrees``, ``keys[3]``
    has the 4-grams whose code lengths are broadcast."""

    def __init__(self, counts: DataFrame, total: int, kind: str, max_grams: int):
        spark = counts.sparkSession
        checkpoint_dir(spark)
        self.kind = kind
        self.parts = max(1, min(1 << 16, total // PART_GRAMS))
        self.counts = counts.withColumn("part", self._part(F.col("gram"))).checkpoint()
        two = F.col("gram").bitwiseAND(_MASKS[1])
        low = ContextTrees(*_columns(self.counts.groupBy("label", two.alias("gram"))
                                     .agg(F.sum("n").alias("n"))), kind, order=1)
        self.labels = low.labels
        self.low = spark.sparkContext.broadcast(low)
        frequent = (self.counts.groupBy("gram").agg(F.sum("n").alias("n"))
                    .orderBy(F.desc("n"), "gram").limit(max_grams // len(self.labels)))
        table = self.code_lengths(frequent.select("gram")).orderBy("gram").toArrow()
        keys = table["gram"].to_numpy().astype(np.uint32)
        bits = np.array(table["bits"].to_pylist(), float).reshape(len(keys), len(self.labels))
        self.keys = [*low.keys, np.zeros(0, np.uint32), keys]
        self.shared = spark.sparkContext.broadcast((HashIndex(keys), bits))

    def _part(self, gram: Column) -> Column:
        middle = F.shiftright(gram, 8).bitwiseAND(_MASKS[1])
        return F.pmod(middle, F.lit(self.parts))

    def code_lengths(self, grams: DataFrame) -> DataFrame:
        """``gram, bits`` of distinct 4-grams, bits by class."""
        low, kind = self.low, self.kind

        def run(counts, wanted):
            trees = ContextTrees(counts["label"].to_pylist(),
                                 counts["gram"].to_numpy().astype(np.uint32),
                                 counts["n"].to_numpy(), kind, lower=low.value)
            bits = trees.code_lengths(wanted["gram"].to_numpy().astype(np.uint32))
            return pa.table({"gram": wanted["gram"],
                             "bits": pa.array(list(bits.astype(float)), pa.list_(pa.float64()))})

        wanted = grams.withColumn("part", self._part(F.col("gram")))
        return (self.counts.groupBy("part").cogroup(wanted.groupBy("part"))
                .applyInArrow(run, "gram long, bits array<double>"))

    def with_bits(self, docs: DataFrame, text: Column, out: str) -> DataFrame:
        """``docs``, a stored table, with the total bits of ``text`` (not null) by class."""
        shared = self.shared
        row = fresh(docs, "row")
        numbered = placed(docs, row)

        def run(batches):
            index, known = shared.value
            for batch in batches:
                rows = ((i, t.as_py().encode()) for i, t in enumerate(batch.column(1)))
                for block in _blocks(rows):
                    codes, ends = grams([t for _, t in block])
                    owner = np.repeat(np.arange(len(block)), np.diff(ends, prepend=0))
                    at = index.find(codes)
                    bits = np.zeros((len(block), known.shape[1]))
                    for c in range(known.shape[1] if len(known) else 0):
                        bits[:, c] = np.bincount(owner[at >= 0], known[at[at >= 0], c], len(block))
                    rest, n = np.unique(owner[at < 0] << 32 | codes[at < 0].astype(np.int64),
                                        return_counts=True)
                    cuts = np.searchsorted(rest >> 32, np.arange(len(block) + 1)).astype(np.int32)
                    other = pa.StructArray.from_arrays(
                        [pa.array(rest & _MASKS[3]), pa.array(n.astype(np.int64))], ["gram", "n"])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(block[0][0], len(block)),
                         pa.array(list(bits), pa.list_(pa.float64())),
                         pa.ListArray.from_arrays(pa.array(cuts), other)],
                        names=["row", "bits", "rest"])

        texts = numbered.select(F.col(row).alias("row"), text.alias("text"))
        made = StructType.fromDDL("bits array<double>, rest array<struct<gram:bigint,n:bigint>>")
        parts = texts.mapInArrow(
            run, StructType([texts.schema["row"], *made.fields])).checkpoint()
        rest = parts.select("row", F.inline("rest"))
        # Sums by class before rows meet again: a text has as many as there are classes.
        more = (rest.join(self.code_lengths(rest.select("gram").distinct()), "gram")
                .select("row", "n", F.posexplode("bits").alias("class", "each"))
                .groupBy("row", "class").agg(F.sum(F.col("n") * F.col("each")).alias("sum"))
                .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("class", "sum")))
                                    .alias("more")))
        total = F.when(F.col("more").isNull(), F.col("bits")).otherwise(
            F.zip_with("bits", F.col("more")["sum"], lambda a, b: a + b))
        totals = parts.join(more, "row", "left").select(F.col("row").alias(row), total.alias(out))
        return numbered.join(totals, row).drop(row)
