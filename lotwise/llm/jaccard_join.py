"""Exact Jaccard self-join of documents on word shingles: a size-aware heavy-light join.

A document's set holds its distinct shingles of ``size`` words (A-Z lower-cased, split at ASCII white
space).  Two sets link when their Jaccard similarity is at least ``percent`` / 100.  No link is lost.

1. One scan hashes the sets.  Equal sets are one class from here on; its number is the place of its first row, so a
   scan of the texts knows it.
2. *Light* sets, up to a boundary size, enumerate their subsets of each fixed size c that an intersection can
   have, c >= percent / 100 * size.  Two sets that share a subset of c link if their sizes allow it, so
   the list of a subset needs no look at its sets.  Sets above the boundary that can link with a
   light one enumerate the subsets up to the boundary's size.
3. *Heavy* sets go to inverted lists.  The lists are of slices: a set is cut by ranges of the hash
   into m slices, m more than the two sets of a link can differ by (plus ``SPARE``), so by the pigeonhole principle
   at least one slice is the same in both and not empty.  A list of single shingles would hold every document with
   a frequent line; a list of a slice holds sets that agree in all of a range.  m depends on a size class;
   a set goes to the lists of each class that the smaller set of a link may be in.  A set with too many
   empty slices also goes to lists of its least shingles, as many as a link can't do without
   (only pairs of such sets need them).  Large sets are first cut into wide ranges of the hash, each a
   set of its own with lists of its own: of two similar sets, the parts in at least one range are as similar.
   Slices are as large as the texts and aren't stored: a scan makes the narrow entries of the lists, another one
   the slices of the sets that share a list, a byte of hash and a byte of size for each.
4. The boundary is the one of least cost: keys written, by the numbers of classes of each size
   (a table of at most ``SMALL`` rows).
5. Of lists with the same members one is scanned, in blocks of bounded size.  Blocks are cut on the narrow rows; slices, and
   sets later, move only to their row's node and from there to their blocks.  A differing slice differs by at least one element, by two if the
   sizes are equal; pairs whose slices differ too much in sum are out.  The others leave the task
   as edges that join groups, fewer than it has rows.
6. Groups of the remaining candidates get their full sets (the last scan of the texts).
   Within a group, again in blocks, an inverted index of shingles is scanned for each set, which gives exact
   intersections with all others.  Links are counted for each set; those that join components leave the task.

Rows are never expanded into pairs: a group of n sets in b blocks writes n * b rows and compares
n * n / 2 pairs in memory, as the number of links asks for.  The driver sees counts and the size
table.

Defined cases: null texts and texts without words have an empty set and link with nothing; a text of
fewer words than a shingle is one shingle; the component id is the least id of the component (null ids come last);
repeated rows are copies; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

from bisect import bisect_right
from hashlib import blake2b
from itertools import combinations, count
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType, LongType, StructType

from lotwise.llm import shingles
from lotwise.llm.components import components
from lotwise.llm.rows import filter_bits, key_bitmap, may_contain, placed
from lotwise.session import checkpoint_dir

SHINGLE_WORDS, PERCENT = 5, 80
#: Slices beyond those that a link may differ in.
SPARE = 5
#: Size classes of heavy sets grow by this factor.
CLASS_GROWTH = 1.4
#: Elements of a part of a large set, about.
PART = 4096
#: The largest boundary; beyond, the subsets of one set are too many.
LARGEST_BOUNDARY = 20
#: Elements (slices or shingles) of the sets of a block.
BLOCK = 1 << 18

WORD = shingles.byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
_LONGS = pa.list_(pa.int64())


def sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashes, bounds = shingles.words(texts, WORD)
    gram = shingles.grams(hashes, size)
    out = []
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if last - first >= size:
            out.append(np.unique(gram[first:last - size + 1]))
        else:
            out.append(shingles.grams(hashes[first:last], last - first)[:int(last > first)])
    return out


class Plan:
    """Which sets can link at a similarity, and the keys under which they meet."""

    def __init__(self, percent: int):
        self.percent = percent
        self.small = self.largest_partner(LARGEST_BOUNDARY)
        self.lows = [1]

    def least_partner(self, size: int) -> int:
        """The size of the smallest set, and intersection, that a set of ``size`` can link with."""
        return -(-self.percent * size // 100)

    def largest_partner(self, size: int) -> int:
        return 100 * size // self.percent

    def links(self, both, size_a, size_b):
        return 100 * both >= self.percent * (size_a + size_b - both)

    def low(self, number: int) -> int:
        """The least size of a size class."""
        while len(self.lows) <= number:
            self.lows.append(max(self.lows[-1] + 1, int(self.lows[-1] * CLASS_GROWTH)))
        return self.lows[number]

    def size_class(self, size: int) -> int:
        while self.lows[-1] <= size:
            self.low(len(self.lows))
        return bisect_right(self.lows, size) - 1

    def slices(self, number: int) -> int:
        """How many slices a size class has: more than the sets of a link differ by."""
        largest = self.low(number + 1) - 1
        return self.largest_partner(largest) - largest + 1 + SPARE

    def classes(self, size: int) -> range:
        return range(self.size_class(self.least_partner(size)), self.size_class(size) + 1)

    def alone(self, size: int) -> bool:
        """No other set can link with one of this size."""
        return self.least_partner(size) == size == self.largest_partner(size)

    def subsets(self, size: int, boundary: int) -> int:
        """How many subsets a set enumerates."""
        if self.alone(size):
            return 0
        return sum(comb(size, c) for c in range(self.least_partner(size), min(size, boundary) + 1))

    def boundary(self, numbers: dict[int, int]) -> int:
        """The boundary with the least cost, from the number of classes of each size up to ``small``.  A
        heavy set costs a key and a list's entry for each slice, a light one a key for each subset."""
        def cost(x):
            total = 0
            for size, number in numbers.items():
                total += number * self.subsets(size, x)
                if size > x:
                    total += 2 * number * sum(min(self.slices(c), size) for c in self.classes(size))
            return total

        return min(range(LARGEST_BOUNDARY + 1), key=cost)

    def parts(self, own: np.ndarray):
        """``(number of the part's list space, part, its hashes within the range as 32 bits, size classes of the
        part)``.  A set in one part has its own class; a smaller part, like a set, those that a partner may have."""
        for number in self.classes(len(own)):
            ranges = max(1, (self.low(number + 1) - 1) // PART)
            scaled = (own >> np.uint64(32)) * np.uint64(ranges)
            edges = np.searchsorted(scaled, np.arange(ranges + 1, dtype=np.uint64) << np.uint64(32))
            for r in range(ranges):
                first, last = edges[r:r + 2].tolist()
                if first < last:
                    part = own[first:last]
                    classes = [number] if ranges == 1 else self.classes(len(part))
                    yield (number << 40) + r, part, scaled[first:last] & np.uint64(0xFFFFFFFF), classes

    def grids(self, own: np.ndarray):
        """``(tag, size, hashes of the slices (0: empty), their sizes, keys of least shingles)`` of each part in
        each of its size classes.  Grids can be compared if their tags are equal."""
        for space, part, place, classes in self.parts(own):
            for number in classes:
                m = self.slices(number)
                at = (place * np.uint64(m) >> np.uint64(32)).astype(np.int64)
                start = np.flatnonzero(np.diff(at, prepend=-1))
                tag = int(shingles.mix(np.array([(space << 8) + number], np.uint64))[0])
                hashes, sizes = np.zeros(m, np.uint64), np.zeros(m, np.uint8)
                sizes[at[start]] = np.minimum(np.diff(start, append=len(part)), MOST)
                total = np.add.reduceat(shingles.mix(part), start)
                hashes[at[start]] = shingles.mix(
                    total ^ shingles.mix(np.uint64(tag) + at[start].astype(np.uint64)))
                least = part[:0]
                if m - len(start) > SPARE:
                    least = part[:len(part) - self.least_partner(len(part)) + 1]
                yield tag, len(part), hashes, sizes, shingles.mix(least ^ np.uint64(tag))


def _subset_keys(own: np.ndarray, plan: Plan, boundary: int):
    """``(key, c)`` of the subsets of a small set."""
    mixed = shingles.mix(own)
    if plan.alone(len(own)):
        return
    for c in range(plan.least_partner(len(own)), min(len(own), boundary) + 1):
        chosen = np.array(list(combinations(range(len(own)), c)), np.int64).reshape(-1, c)
        for key in shingles.mix(mixed[chosen].sum(axis=1) + np.uint64(c)).view(np.int64).tolist():
            yield key, c


_KEY = StructType().add("at", IntegerType()).add("key", "long")
_ENTRY = StructType().add("tag", "long").add("size", "long").add("hashes", "binary").add("sizes", "binary")
#: Sizes of slices are written as bytes; this one means "so many or more".
MOST = 255


def _structs(lengths, arrays: list, of: StructType) -> pa.ListArray:
    offsets = np.cumsum([0, *lengths]).astype(np.int32)
    return pa.ListArray.from_arrays(
        pa.array(offsets), pa.StructArray.from_arrays(arrays, names=of.fieldNames()))


def _key_array(of_sets: list[list[tuple]]) -> pa.ListArray:
    """Numbers of a set's grids and the keys of the lists that each goes to."""
    places, keys, lengths = [np.zeros(0, np.int32)], [np.zeros(0, np.uint64)], []
    for grids in of_sets:
        lengths.append(0)
        for at, (_, _, hashes, _, least) in enumerate(grids):
            own = np.concatenate([hashes[hashes != 0], least[least != 0]])
            places.append(np.full(len(own), at, np.int32))
            keys.append(own)
            lengths[-1] += len(own)
    return _structs(lengths, [pa.array(np.concatenate(places)), pa.array(np.concatenate(keys).view(np.int64))], _KEY)


def _grid_array(of_sets: list[list[tuple]]) -> pa.ListArray:
    entries = [entry for grids in of_sets for entry in grids]
    tag, size, hashes, sizes = ([e[i] for e in entries] for i in range(4))
    # A byte of a hash will do: slices that are alike by chance, one differing one in 256, can only make a
    # pair a candidate.
    arrays = [pa.array(np.array(tag, np.uint64).view(np.int64)), pa.array(size, pa.int64()),
              pa.array([h.astype(np.uint8).tobytes() for h in hashes], pa.binary()),
              pa.array([s.tobytes() for s in sizes], pa.binary())]
    return _structs(map(len, of_sets), arrays, _ENTRY)


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number ``node`` of each row, the same in every scan: 31 bits for its file, 32 for its place there."""
    rows = placed(docs, "__place")
    files = rows.select("__place.file").distinct().checkpoint()
    n = files.count()
    for salt in count():
        number = F.pmod(F.xxhash64("file", F.lit(salt)), F.lit(1 << 31))
        if files.select(number).distinct().count() == n:
            break
    number = F.pmod(F.xxhash64("__place.file", F.lit(salt)), F.lit(1 << 31))
    return rows.withColumn("node", F.shiftleft(number, 32).bitwiseOR(F.col("__place.row"))).drop("__place")


def _profiles(docs: DataFrame, size: int, plan: Plan) -> DataFrame:
    """``node, doc_id, n_shingles, set_key`` and of small sets the set."""
    schema = (StructType([docs.schema["node"], docs.schema["doc_id"]]).add("n_shingles", "long")
              .add("set_key", "binary").add("small", ArrayType(LongType())))

    def run(batches):
        for batch in batches:
            counts, keys, small = [], [], []
            for block in shingles.text_blocks((t.as_py() or "").encode() for t in batch.column(2)):
                for own in sets(block, size):
                    counts.append(len(own))
                    keys.append(blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                    small.append(own.view(np.int64) if len(own) <= plan.small else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(small, _LONGS)], names=schema.fieldNames())

    return docs.select("node", "doc_id", "text").mapInArrow(run, schema)


def _of_sets(rows: DataFrame, size: int, name: str, made: DataType, make) -> DataFrame:
    """``node`` and, as ``name``, what ``make`` returns as an array for a list of sets."""
    schema = StructType().add("node", "long").add(name, made)

    def run(batches):
        for batch in batches:
            done = 0
            for block in shingles.text_blocks((t.as_py() or "").encode() for t in batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, len(block)), make(sets(block, size))], names=schema.fieldNames())
                done += len(block)

    return rows.select("node", "text").mapInArrow(run, schema)


def _likely(rows: DataFrame, nodes: DataFrame, each: int = 16) -> DataFrame:
    """The rows of ``nodes``, and a few others: one in ``each``, more where the filter is at its largest."""
    bits = filter_bits(nodes.count(), each)
    return rows.where(may_contain(key_bitmap(nodes, ["node"], bits), [F.col("node")], bits))


def _subsets(small: DataFrame, plan: Plan, boundary: int) -> DataFrame:
    """``key, c, node, size`` of the subsets of small sets."""
    def run(batches):
        for batch in batches:
            rows = [(key, c, node, len(own)) for node, own in zip(
                        batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for key, c in _subset_keys(np.array(own, np.int64).view(np.uint64), plan, boundary)]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.int64()) for c in columns[1:])],
                names=["key", "c", "node", "size"])

    return small.select("node", "small").mapInArrow(run, "key long, c long, node long, size long")


def _light_edges(subsets: DataFrame, percent: int) -> DataFrame:
    """Links of each subset's sets with the smallest of them: if any two link by it, both link so."""
    hubs = (subsets.groupBy("key", "c").agg(F.min(F.struct("size", "node")).alias("hub"),
                                            F.max("node").alias("last"), F.min("node").alias("first"))
            .where("first != last").select("key", "c", "hub"))
    pairs = subsets.join(hubs, ["key", "c"]).where("node != hub.node")
    union = F.col("size") + F.col("hub.size") - F.col("c")
    return (pairs.where(100 * F.col("c") >= percent * union)
            .select(F.col("hub.node").alias("a"), F.col("node").alias("b")).distinct())


# ---- blocks ------------------------------------------------------------------------------

def _dealt(rows: DataFrame, group: str, weight: Column) -> DataFrame:
    """Stored narrow ``rows`` for each pair of blocks of their group; ``weight`` fills a block to ``BLOCK``."""
    sizes = rows.groupBy(group).agg(F.sum(weight).alias("__total"))
    return (rows.join(sizes, group)
            .withColumn("__blocks", F.ceil(F.col("__total") / BLOCK).cast("int"))
            .withColumn("own", F.pmod(F.xxhash64("node"), F.col("__blocks")).cast("int"))
            .withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
            .withColumn("low", F.least("own", "__other")).withColumn("high", F.greatest("own", "__other"))
            .drop("__total", "__blocks", "__other"))


def _gathered(rows: DataFrame, group: list[str]) -> DataFrame:
    """Dealt ``rows``, those of a pair of blocks one after the other."""
    key = [*group, "low", "high"]
    return rows.repartition(*key).sortWithinPartitions(*key)


def _groups(batches, group: list[str]):
    """Tables of the pairs of blocks, each with ``low`` and ``high``; one may go over several batches."""
    key, held = None, []
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in (*group, "low", "high"))))
        edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for first, last in zip(edges, edges[1:]):
            if first < last:
                if keys[first] != key and held:
                    yield pa.Table.from_batches(held), *key[-2:]
                    held = []
                key = keys[first]
                held.append(batch.slice(first, last - first))
    if held:
        yield pa.Table.from_batches(held), *key[-2:]


def _edge_batch(links: list, counts=()) -> pa.RecordBatch:
    rows = [(a, b, None) for a, b in links] + [(a, None, n) for a, n in counts]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)],
                                      names=["a", "b", "n"])


_EDGES = "a long, b long, n long"


def _candidates_in(part: pa.Table, low: int, high: int, plan: Plan) -> list:
    """Pairs that the slices leave possible and that join groups of the block."""
    own, node, size = (part[c].to_numpy() for c in ("own", "node", "size"))
    hashes, sizes = (np.stack([np.frombuffer(v.as_buffer(), np.uint8) for c in part[name].chunks for v in c])
                     for name in ("hashes", "sizes"))
    sizes = sizes.astype(np.int16)
    label, links = np.arange(len(node)), []
    for i in np.flatnonzero(own == low).tolist():
        other = (own == high) & (label != label[i])
        if low == high:
            other[:i + 1] = False
        least, most = plan.least_partner(int(size[i])), plan.largest_partner(int(size[i]))
        other = np.flatnonzero(other & (size >= least) & (size <= most))
        if not len(other):
            continue
        gap = np.abs(sizes[other] - sizes[i])
        differ = (gap == 0) & (hashes[other] != hashes[i])
        gap[differ] = np.where(sizes[i] < MOST, 2, 1)[np.nonzero(differ)[1]]
        total = size[other] + size[i]
        near = other[plan.links((total - gap.sum(axis=1)) // 2, size[other], size[i])]
        for j in near.tolist():
            if label[j] != label[i]:
                links.append((node[i], node[j]))
                label[label == label[j]] = label[i]
    return links


def _heavy_edges(rows: DataFrame, heavy: DataFrame, size: int, plan: Plan) -> DataFrame:
    """Edges between the sets of ``heavy`` (``node, n_shingles``) that share a list and whose slices leave a link
    possible."""
    keys = _of_sets(_likely(rows, heavy), size, "keys", ArrayType(_KEY),
                    lambda own: _key_array([list(plan.grids(s)) for s in own]))
    # The narrow rows are shuffled once, for the aggregate and for the join.
    entries = (keys.select("node", F.explode("keys").alias("k")).select("node", "k.at", "k.key")
               .where("key is not null and node is not null").repartition("key"))
    shared = (entries.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"),
                                         F.max("at").alias("at"))     # the join's columns: one exchange serves both
              .where("first != last and at >= 0").select("key"))
    # Stored by itself: a filter of the next join, pushed below the exchange, would make it two.
    members = entries.join(shared, "key").checkpoint()
    members = members.join(heavy, "node").checkpoint()      # without the few other rows
    # Near copies share many lists; of those with the same members (by two hashes of 64 bits) one is scanned.
    alike = members.groupBy("key").agg(
        F.count("*").alias("n"), F.min("node").alias("least"), F.max("node").alias("last"),
        F.bit_xor(F.xxhash64("node", "at")).alias("x"), F.bit_xor(F.xxhash64("at", "node", F.lit(1))).alias("y"))
    kept = (alike.where("least != last").groupBy("n", "least", "x", "y").agg(F.min("key").alias("key"))
            .select("key"))
    listed = members.join(kept, "key").checkpoint()
    # Grids are large: only sets in a list get them, from their texts, when their blocks are known.
    nodes = listed.select("node").distinct().checkpoint()
    grids = _of_sets(_likely(rows, nodes, 64), size, "grids", ArrayType(_ENTRY),
                     lambda own: _grid_array([list(plan.grids(s)) for s in own]))
    slim = grids.select("node", F.posexplode("grids").alias("at", "g")).select(
        "node", "at", "g.tag", "g.size", "g.hashes", "g.sizes")
    # A part's slices, or a few more (``Plan.slices`` of the largest class it can be in).
    share = CLASS_GROWTH * (100 / plan.percent - 1)
    slices = F.ceil(F.least("n_shingles", F.lit(2 * PART)) * share) + SPARE + 2
    dealt = _dealt(listed, "key", slices).drop("n_shingles")
    group = ["key", "tag"]

    def scan(batches):
        for part, low, high in _groups(batches, group):
            yield _edge_batch(_candidates_in(part, low, high, plan))

    return (_gathered(dealt.join(slim, ["node", "at"]).drop("at"), group).mapInArrow(scan, _EDGES)
            .select("a", "b").distinct())


def _links_in(part: pa.Table, low: int, high: int, plan: Plan):
    """Links that join components of the block, and how many links each set has in it."""
    own, node = part["own"].to_numpy(), part["node"].to_numpy()
    full = [np.frombuffer(v.as_buffer(), np.uint64) for c in part["shingles"].chunks for v in c]
    sizes = np.fromiter(map(len, full), np.int64, len(full))
    ends = np.cumsum(sizes)
    # Inverted lists: of shingle s the sets holder[begin[s]:begin[s + 1]].
    _, number = np.unique(np.concatenate(full), return_inverse=True)
    order = np.argsort(number, kind="stable")
    holder = np.repeat(np.arange(len(full)), sizes)[order]
    begin = np.searchsorted(number[order], np.arange(int(number.max()) + 2))
    count = np.zeros(len(full), np.int64)
    label, links = np.arange(len(full)), []
    for i in np.flatnonzero(own == low).tolist():
        mine = number[ends[i] - sizes[i]:ends[i]]
        first, n = begin[mine], begin[mine + 1] - begin[mine]
        places = np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        both = np.bincount(holder[places], minlength=len(full))
        linked = plan.links(both, sizes, sizes[i]) & (own == high)
        if low == high:
            linked[:i + 1] = False
        linked = np.flatnonzero(linked)
        count[i] += len(linked)
        count[linked] += 1
        for j in linked.tolist():
            if label[j] != label[i]:
                links.append((node[i], node[j]))
                label[label == label[j]] = label[i]
    has = np.flatnonzero(count)
    return links, zip(node[has].tolist(), count[has].tolist())


def _full_sets(wanted: DataFrame, rows: DataFrame, size: int) -> DataFrame:
    """``wanted`` (``node, ...``) with ``shingles``, made from the texts again."""
    made = _of_sets(_likely(rows, wanted.select("node").distinct(), 64), size, "shingles", BinaryType(),
                    lambda own: pa.array([s.tobytes() for s in own], pa.binary()))
    return made.join(wanted, "node")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, class_id`` (the least id with an equal set),
    ``class_size``, ``n_links`` (other classes that its class links with), ``component_id`` (the least id
    reachable by links).  ``docs`` should be a stored table: it is scanned four times."""
    if not 50 < percent <= 100:
        raise ValueError("percent has to be above 50")
    checkpoint_dir(docs.sparkSession)
    plan = Plan(percent)
    slim = _numbered(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    profiles = _profiles(slim, shingle_words, plan).checkpoint()
    least = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id")
    classes = (profiles.where("set_key is not null").groupBy("set_key", "n_shingles")
               .agg(F.min(least).alias("least"), F.count("*").alias("class_size"),
                    F.min("node").alias("node"), F.first("small").alias("small")).checkpoint())

    small = classes.where("small is not null")
    numbers = {r["n_shingles"]: r["count"] for r in small.groupBy("n_shingles").count().collect()}
    boundary = plan.boundary(numbers)
    heavy = classes.where(F.col("n_shingles") > boundary).select("node", "n_shingles")
    light = _subsets(small, plan, boundary)
    edges = (_light_edges(light, percent).unionByName(_heavy_edges(slim, heavy, shingle_words, plan))
             .checkpoint())

    groups = components(edges).withColumnRenamed("label", "group")
    wanted = classes.select("node", "n_shingles").join(groups, "node").checkpoint()
    dealt = _dealt(wanted, "group", F.col("n_shingles")).drop("n_shingles").checkpoint()
    full = _gathered(_full_sets(dealt, slim, shingle_words), ["group"])

    def scan(batches):
        for part, low, high in _groups(batches, ["group"]):
            yield _edge_batch(*_links_in(part, low, high, plan))

    found = full.mapInArrow(scan, _EDGES).checkpoint()
    links = found.where("b is not null").select("a", "b")
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("n_links"))
    return _by_document(profiles, classes, components(links), counts)


def _by_document(profiles: DataFrame, classes: DataFrame, labels: DataFrame, counts: DataFrame) -> DataFrame:
    slim = classes.select("set_key", "node", "least", "class_size")
    labelled = (slim.join(labels, "node", "left").join(counts.withColumnRenamed("a", "node"), "node", "left")
                .select("set_key", "least", "class_size", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                        F.coalesce("label", "node").alias("label")))
    least = labelled.groupBy("label").agg(F.min("least").alias("first"))
    of_set = (labelled.join(least, "label")
              .select("set_key", F.col("least.doc_id").alias("class_id"), "class_size", "n_links",
                      F.col("first.doc_id").alias("component_id")).checkpoint())
    rows = profiles.select("doc_id", "n_shingles", "set_key")
    linked = rows.where("set_key is not null").join(of_set, "set_key").drop("set_key")
    alone = rows.where("set_key is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"),
        F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)
