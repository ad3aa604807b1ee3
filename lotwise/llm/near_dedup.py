"""Near-duplicate components by MinHash bands and odd sketches.

A document's set holds its distinct shingles of ``size`` words (A-Z lower-cased, split at
ASCII white space).  Documents whose sets have a Jaccard similarity of at least
``percent`` are linked; components of links are groups.

1. Each document is read once: its set, a MinHash signature of
   ``bands * rows`` samples, a hash for each band, and an odd sketch: a bitmap in which every
   (sample number, sample) flips one bit.  Equal samples of two documents cancel in the
   XOR of their sketches, so its population count tells how many samples differ,
   ``differing = -bits / 4 * ln(1 - 2 * count / bits)``, most precisely where few do.
2. Documents with equal sets form a class; one row stands for it from here on.
3. Classes that share a band hash are candidates.  A star round verifies each class against
   one hub only: among the least classes of its bands the one whose sketch is closest.
   It links large groups with one pair for each member.
4. Pairs within a band that are still in different components are all compared where they
   meet, in blocks of bounded size, each pair in the first band that it shares: by sketch first; the
   rows that the sketches leave a chance get their full sets and meet again.  Only links that join components of
   the block leave the task, fewer than it has rows, so a group of thousands of
   documents just below the threshold makes no table of pairs.
5. Full sets come from a second scan, for classes that share a band hash with another one
   (a bitmap, sized by their number, lets the others pass by).

With 32 bands of 5 rows a pair at 0.8 fails to be a candidate with a probability of 3e-6.
The sketch rejects a pair only beyond ``MAX_DIFFERING`` estimated differing samples: at 0.8, 32 of 160
are expected to differ, with a deviation of 5.1 and some 5 from the sketch; 68 is 5 deviations off.

Defined cases: null texts and texts without words have an empty set and are linked with nothing,
not even with each other; a text of fewer words than a shingle is one shingle; the
component id is the least id of the group (null ids come last), of repeated ids the
earliest row stays; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from lotwise.llm import shingles
from lotwise.llm.components import components
from lotwise.llm.rows import filter_bits as bits_for
from lotwise.llm.rows import fresh, key_bitmap, may_contain, placed
from lotwise.session import checkpoint_dir

SHINGLE_WORDS, PERCENT = 5, 80
BANDS, ROWS = 32, 5
SKETCH_BITS = 512
MAX_DIFFERING = 68
BLOCK = 1024
SHINGLES_AT_ONCE = 1 << 15

WORD = shingles.byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
_SEEDS = shingles.mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64)).reshape(2, -1)


def sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashes, bounds = shingles.words(texts, WORD)
    gram = shingles.grams(hashes, size)
    out = []
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if last - first >= size:
            out.append(np.unique(gram[first:last - size + 1]))
        else:  # the whole sequence, or nothing
            out.append(shingles.grams(hashes[first:last], last - first)[:int(last > first)])
    return out


def signatures(own: list[np.ndarray]) -> np.ndarray:
    """MinHash samples (sets, samples) of non-empty sets."""
    out = np.empty((len(own), BANDS * ROWS), np.uint32)
    sizes = np.fromiter(map(len, own), np.int64, len(own))
    first = 0
    while first < len(own):
        last, held = first + 1, sizes[first]
        while last < len(own) and held + sizes[last] <= SHINGLES_AT_ONCE:
            held += sizes[last]
            last += 1
        x = (np.concatenate(own[first:last]) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum(sizes[first:last]) - sizes[first:last]
        for i, (flip, odd) in enumerate(zip(*_SEEDS.astype(np.uint32))):
            out[first:last, i] = np.minimum.reduceat((x ^ flip) * (odd | np.uint32(1)), starts)
        first = last
    return out


def band_hashes(samples: np.ndarray) -> np.ndarray:
    wide = samples.astype(np.uint64).reshape(len(samples), BANDS, ROWS)
    total = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), wide.shape[:2])
    for i in range(ROWS):
        total = shingles.mix(total * np.uint64(31) + wide[:, :, i])
    return total


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps (sets, words of 64 bits)."""
    number = np.arange(samples.shape[1], dtype=np.uint64) << np.uint64(32)
    bit = (shingles.mix(samples.astype(np.uint64) | number) % np.uint64(SKETCH_BITS))
    out = np.zeros((len(samples), SKETCH_BITS // 64), np.uint64)
    row = np.arange(len(samples))
    for i in range(samples.shape[1]):
        out[row, (bit[:, i] >> np.uint64(6)).astype(np.int64)] ^= (
            np.uint64(1) << (bit[:, i] & np.uint64(63)))
    return out


def max_count(differing: int = MAX_DIFFERING) -> int:
    """The population count that so many differing samples (two flips each) lead to."""
    return int(SKETCH_BITS / 2 * (1 - np.exp(-4 * differing / SKETCH_BITS)))


def _texts(batch: pa.RecordBatch, at: int):
    return ((t.as_py() or "").encode() for t in batch.column(at))


def _profiles(docs: DataFrame, size: int) -> DataFrame:
    schema = (StructType([*docs.schema.fields[:2]]).add("n_shingles", "long")
              .add("set_key", "binary").add("bands", ArrayType(LongType()))
              .add("sketch", ArrayType(LongType())))

    def run(batches):
        from hashlib import blake2b

        for batch in batches:
            counts, keys, bands, sketches = [], [], [], []
            for block in shingles.text_blocks(_texts(batch, 2)):
                own = sets(block, size)
                full = [i for i, s in enumerate(own) if len(s)]
                counts += map(len, own)
                rows: list = [(None, None, None)] * len(own)
                if full:
                    samples = signatures([own[i] for i in full])
                    for i, b, k in zip(full, band_hashes(samples).view(np.int64).tolist(),
                                       odd_sketches(samples).view(np.int64).tolist()):
                        rows[i] = (blake2b(own[i].tobytes(), digest_size=16).digest(), b, k)
                for key, b, k in rows:
                    keys.append(key)
                    bands.append(b)
                    sketches.append(k)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()),
                 pa.array(keys, pa.binary()), pa.array(bands, longs), pa.array(sketches, longs)],
                names=["row_id", "doc_id", "n_shingles", "set_key", "bands", "sketch"])

    return docs.mapInArrow(run, schema)


def _differing_bits(a: str, b: str) -> Column:
    """Population count of the XOR of two sketch columns."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                       F.lit(0), lambda s, x: s + x)


def _full_sets(wanted: DataFrame, docs: DataFrame, size: int, filter_bits: int) -> DataFrame:
    """``node, shingles`` of ``wanted`` (``node, row_id``), made from their texts again."""
    likely = docs.where(may_contain(key_bitmap(wanted, ["row_id"], filter_bits),
                                    [F.col("row_id")], filter_bits))
    schema = StructType([docs.schema["row_id"]]).add("shingles", "binary")

    def make(batches):
        for batch in batches:
            own = [s.tobytes() for block in shingles.text_blocks(_texts(batch, 2))
                   for s in sets(block, size)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary())],
                                             names=["row_id", "shingles"])

    return likely.mapInArrow(make, schema).join(wanted, "row_id").select("node", "shingles")


def _verify(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    def compare(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            kept = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(kept),
                                              batch.column("b").filter(kept)], names=["a", "b"])

    both = (pairs.join(full.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
            .join(full.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b"))
    return both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def _columns(part: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``own, label, sketch, bands`` of a block's rows."""
    label = np.unique(part["label"].to_numpy(), return_inverse=True)[1]
    # Unsigned: of a negative number, numpy would count the bits of its absolute value.
    sketch = np.array(part["sketch"].to_pylist(), np.int64).view(np.uint64)
    return part["own"].to_numpy(), label, sketch, np.array(part["bands"].to_pylist(), np.int64)


def _near_pairs(columns: tuple, sizes: np.ndarray, key: tuple, percent: int):
    """``i, rows``: the rows of other components that sizes and sketches leave a chance with row ``i``.
    ``label`` is read anew for each ``i``."""
    own, label, sketch, bands = columns
    band, low, high = key
    closest = max_count()
    for i in np.flatnonzero(own == low).tolist():
        near = (own == high) & (label != label[i])
        if low == high:
            near[:i + 1] = False
        near &= np.bitwise_count(sketch ^ sketch[i]).sum(axis=1) <= closest
        near &= 100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i])
        near = np.flatnonzero(near)
        if len(near):  # each pair is looked at in the first band that it shares
            same = bands[near] == bands[i]
            near = near[bands[near, same.argmax(axis=1)] == band]
        if len(near):
            yield i, near


def _near_in_block(part: pa.Table, key: tuple, percent: int) -> pa.RecordBatch:
    """The rows of a block that have such a pair there."""
    wanted = np.zeros(part.num_rows, bool)
    for i, near in _near_pairs(_columns(part), part["size"].to_numpy(), key, percent):
        wanted[i] = wanted[near] = True
    kept = part.select(["band", "low", "high", "own", "node", "label"]).filter(pa.array(wanted))
    return pa.RecordBatch.from_arrays([c.combine_chunks() for c in kept.columns], names=kept.column_names)


def _links_in_block(part: pa.Table, key: tuple, percent: int) -> pa.RecordBatch:
    """Links between the two blocks of a band that join components; see the module's text."""
    columns, node = _columns(part), part["node"].to_numpy()
    label = columns[1]
    full = [np.frombuffer(v.as_buffer(), np.uint64) for c in part["shingles"].chunks for v in c]
    sizes = np.fromiter(map(len, full), np.int64, len(full))
    ends = np.cumsum(sizes)
    _, number = np.unique(np.concatenate(full), return_inverse=True)
    marked = np.zeros(int(number.max()) + 1, np.int64)
    links = []
    for i, near in _near_pairs(columns, sizes, key, percent):
        mine = number[ends[i] - sizes[i]:ends[i]]
        marked[mine] = 1
        for j in near.tolist():
            if label[j] != label[i]:
                both = int(marked[number[ends[j] - sizes[j]:ends[j]]].sum())
                if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                    links.append((node[i], node[j]))
                    label[label == label[j]] = label[i]
        marked[mine] = 0
    a, b = (pa.array([x[i] for x in links], pa.int64()) for i in (0, 1))
    return pa.RecordBatch.from_arrays([a, b], names=["a", "b"])


def _by_block(rows: DataFrame, look, percent: int, schema: str) -> DataFrame:
    """``look(part, (band, low, high), percent)`` of each pair of blocks."""
    def run(batches):
        # Rows come sorted by group; a group may go over several batches.
        key, held = None, []
        for batch in batches:
            groups = list(zip(*(batch.column(c).to_pylist() for c in ("band", "low", "high"))))
            edges = [0, *(i for i in range(1, len(groups)) if groups[i] != groups[i - 1]),
                     len(groups)]
            for first, last in zip(edges, edges[1:]):
                if groups[first] != key and held:
                    yield look(pa.Table.from_batches(held), key, percent)
                    held = []
                key = groups[first]
                held.append(batch.slice(first, last - first))
        if held:
            yield look(pa.Table.from_batches(held), key, percent)

    dealt = rows.repartition("band", "low", "high").sortWithinPartitions("band", "low", "high")
    return dealt.mapInArrow(run, schema)


def _links_across(members: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between nodes of a band that are in different components.

    ``members``: ``band, node, label``, of bands with several labels; ``full``: ``node, sketch,
    bands, shingles``.  A band of n nodes is cut into blocks by a hash of the node; each pair of
    blocks is a group.  Sketches go to all groups of a node, its full set only to those where a
    pair is left."""
    sizes = members.groupBy("band").agg(F.count("*").alias("n"))
    cut = (members.join(sizes, "band")
           .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
           .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("band", F.least("own", "other").cast("int").alias("low"),
                   F.greatest("own", "other").cast("int").alias("high"), "own", "node", "label"))
    slim = full.select("node", "sketch", "bands", (F.octet_length("shingles") / 8).cast("long").alias("size"))
    near = _by_block(cut.join(slim, "node"), _near_in_block, percent,
                     "band long, low int, high int, own int, node long, label long")
    return _by_block(near.join(full, "node"), _links_in_block, percent, "a long, b long")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT,
               filter_bits: int | None = None, row_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``row_id, doc_id, n_shingles, component_id, kept``.
    ``row_id`` is the row's place (``rows.placed``), or ``row_col``.  ``kept`` holds for one row of
    each component."""
    checkpoint_dir(docs.sparkSession)
    if row_col is None:
        row_col = fresh(docs, "row_id")
        docs = placed(docs, row_col)
    slim = docs.select(F.col(row_col).alias("row_id"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).alias("text"))
    # The number is stored with the row, so it stays the same whatever reads it.
    profiles = (_profiles(slim, shingle_words).withColumn("number", F.monotonically_increasing_id())
                .checkpoint())

    # Equal sets: a class is known by the number of its first row.
    classes = (profiles.where("set_key is not null").groupBy("set_key")
               .agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "number"))
                    .alias("first"))
               .select("set_key", "first", F.col("first.number").alias("node")).checkpoint())
    nodes = (profiles.select(F.col("number").alias("node"), "bands", "sketch", "row_id")
             .join(classes.select("node"), "node"))

    # The narrow rows are shuffled once, for the aggregate and for the join.
    banded = (nodes.select("node", F.explode("bands").alias("band")).where("band is not null")
              .repartition("band"))
    hubs = (banded.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("last"))
            .where("hub != last").select("band", "hub"))
    members = banded.join(hubs, "band").checkpoint()
    wanted = members.select("node").distinct().checkpoint()
    if filter_bits is None:
        filter_bits = bits_for(wanted.count())
    known = nodes.join(wanted, "node").checkpoint()
    full = (known.drop("row_id").join(
        _full_sets(known.select("node", "row_id"), slim, shingle_words, filter_bits), "node").checkpoint())

    sketches = full.select("node", "sketch")
    of_hub = sketches.select(F.col("node").alias("hub"), F.col("sketch").alias("hub_sketch"))
    offers = (members.where("node != hub").select("node", "hub").distinct()
              .join(sketches, "node").join(of_hub, "hub")
              .withColumn("bits", _differing_bits("sketch", "hub_sketch"))
              .where(F.col("bits") <= max_count()))
    star = (offers.groupBy("node").agg(F.min(F.struct("bits", "hub")).alias("best"))
            .select(F.col("best.hub").alias("a"), F.col("node").alias("b")))
    links = _verify(star, full, percent).checkpoint()

    found = components(links)
    labels = wanted.join(found, "node", "left").select(
        "node", F.coalesce("label", "node").alias("label")).checkpoint()
    labelled = members.select("band", "node").join(labels, "node")
    mixed = (labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"))
             .where("low != high").select("band"))
    rest = labelled.join(mixed, "band")
    links = links.union(_links_across(rest, full, percent)).checkpoint()

    return _grouped(profiles, classes, components(links))


def _grouped(profiles: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Components of classes, brought back to rows."""
    labelled = (classes.join(labels, "node", "left")
                .select("set_key", F.coalesce("label", "node").alias("label"), "first"))
    first = labelled.groupBy("label").agg(F.min("first").alias("best"))
    of_set = (labelled.join(first, "label")
              .select("set_key", F.col("best.doc_id").alias("component_id"),
                      F.col("best.number").alias("best_row")).checkpoint())
    slim = profiles.select("row_id", "number", "doc_id", "n_shingles", "set_key")
    linked = (slim.where("set_key is not null").join(of_set, "set_key")
              .select("row_id", "doc_id", "n_shingles", "component_id",
                      (F.col("number") == F.col("best_row")).alias("kept")))
    alone = slim.where("set_key is null").select(
        "row_id", "doc_id", "n_shingles", F.col("doc_id").alias("component_id"),
        F.lit(True).alias("kept"))
    return linked.unionByName(alone)


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """One document of each component of ``docs``, all columns kept."""
    row = fresh(docs, "row_id")
    docs = placed(docs, row)
    dropped = (near_dedup(docs, row_col=row, **options).where(~F.col("kept"))
               .select(F.col("row_id").alias(row)))
    return docs.join(dropped, row, "left_anti").drop(row)
