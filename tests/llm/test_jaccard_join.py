"""The size-aware Jaccard join against an all-pairs join in plain Python."""
from __future__ import annotations

import random
import re

import pytest

from lotwise.llm import jaccard_join, queries

SCHEMA = "doc_id long, text string"


def words_of(text):
    text = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return [w for w in re.split("[\x20\x09-\x0d]+", text) if w]


def set_of(text, size):
    words = words_of(text)
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def by_hand(rows, size, percent):
    """``doc_id, n_shingles, component_id, class_id, class_size, n_links`` of each row, sorted."""
    held = [(i, set_of(text, size)) for i, text in rows]
    sets = list({s for _, s in held if s})
    parent = list(range(len(sets)))
    links = [0] * len(sets)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if 100 * len(a & b) >= percent * len(a | b):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    number = {s: i for i, s in enumerate(sets)}

    def least(ids):
        ids = list(ids)
        known = [i for i in ids if i is not None]
        return min(known) if known else None

    out = []
    for i, s in held:
        if not s:
            out.append((i, 0, i, i, 1, 0))
            continue
        root = find(number[s])
        copies = [j for j, t in held if t == s]
        out.append((i, len(s), least(j for j, t in held if t and find(number[t]) == root),
                    least(copies), len(copies), links[number[s]]))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select(
        "doc_id", "n_shingles", "component_id", "class_id", "class_size", "n_links").collect()), key=repr)


def changed(rng, words, n):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words) + 1)
        what = rng.random()
        if what < 0.4 and at < len(words):
            words[at] = f"new{rng.randrange(10 ** 6)}"
        elif what < 0.7:
            words.insert(at, f"new{rng.randrange(10 ** 6)}")
        elif at < len(words):
            del words[at]
    return words


def family(rng, n, copies, most):
    base = [f"w{rng.randrange(3000)}" for _ in range(n)]
    return [" ".join(base)] + [" ".join(changed(rng, base, rng.randrange(0, most + 1))) for _ in range(copies)]


def corpus(seed, sizes, copies, most):
    rng = random.Random(seed)
    texts = [t for n in sizes for t in family(rng, n, copies, most)]
    line = " ".join(f"common{i}" for i in range(25))       # a passage that many share
    texts += [f"{line} {' '.join(f'u{rng.randrange(10 ** 6)}' for _ in range(rng.randrange(1, 60)))}"
              for _ in range(40)]
    texts += ["", None, "Two words", "two WORDS", "one"]
    rng.shuffle(texts)
    return list(enumerate(texts)) + [(0, texts[0]), (None, texts[1])]


@pytest.mark.parametrize("seed,size,percent,sizes", [
    (1, 1, 85, range(1, 40)),            # tiny sets: the boundary, subsets, sparse grids
    (2, 4, 85, [8, 9, 10, 12, 15, 18, 22, 26, 30, 60, 120, 300, 700]),
    (3, 2, 70, range(3, 60, 3)),
])
def test_equals_all_pairs(spark, store, seed, size, percent, sizes):
    rows = corpus(seed, sizes, 6, 4)
    docs = store(spark, rows, SCHEMA)
    out = jaccard_join.jaccard_join(docs, shingle_words=size, percent=percent)
    assert result(out) == by_hand(rows, size, percent)


@pytest.mark.parametrize("boundary", [0, 7, 13, 20])
def test_every_boundary_finds_all_links(spark, store, monkeypatch, boundary):
    monkeypatch.setattr(jaccard_join.Plan, "boundary", lambda self, numbers: boundary)
    rows = corpus(9, range(4, 34), 4, 2)
    docs = store(spark, rows, SCHEMA)
    assert result(jaccard_join.jaccard_join(docs, shingle_words=1, percent=85)) == by_hand(rows, 1, 85)


def test_blocks_lose_no_link(spark, store, monkeypatch):
    """A group of near copies over many blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 500)
    rng = random.Random(4)
    rows = list(enumerate(family(rng, 90, 120, 3)))
    docs = store(spark, rows, SCHEMA)
    assert result(jaccard_join.jaccard_join(docs, shingle_words=4, percent=85)) == by_hand(rows, 4, 85)


def test_sets_that_share_no_list_store_little(spark, store, words):
    """Slices of sets are as large as the texts: those of sets without a partner aren't written."""
    import os

    from lotwise.session import checkpoint_dir

    def files():
        folder = checkpoint_dir(spark).removeprefix("file:")
        return {os.path.join(at, f): os.path.getsize(os.path.join(at, f))
                for at, _, names in os.walk(folder) for f in names}

    rows = [(i, words(i, 500)) for i in range(400)]
    docs, before = store(spark, rows, SCHEMA), files()
    out = jaccard_join.jaccard_join(docs, shingle_words=4, percent=85)
    written = sum(n for f, n in files().items() if f not in before)
    assert out.where("n_links = 0 and component_id = doc_id").count() == 400
    assert written < sum(len(t) for _, t in rows) / 2


def test_blocks_are_cut_on_narrow_rows(spark, store, monkeypatch):
    """Neither slices nor sets go through the shuffles that deal rows into blocks."""
    dealt, cut = jaccard_join._dealt, []

    def seen(rows, *more):
        cut.append(set(rows.columns))
        return dealt(rows, *more)

    monkeypatch.setattr(jaccard_join, "_dealt", seen)
    rows = list(enumerate(family(random.Random(6), 300, 30, 8)))
    docs = store(spark, rows, SCHEMA)
    assert result(jaccard_join.jaccard_join(docs, shingle_words=4, percent=85)) == by_hand(rows, 4, 85)
    assert len(cut) == 2 and not any({"hashes", "sizes", "shingles"} & columns for columns in cut)


def test_a_slice_takes_two_bytes():
    plan = jaccard_join.Plan(85)
    grids = list(plan.grids(jaccard_join.sets([" ".join(f"w{i}" for i in range(3000)).encode()], 4)[0]))
    entries = jaccard_join._grid_array([grids]).values
    slices = sum(len(sizes) for _, _, _, sizes, _ in grids)
    assert sum(len(e["hashes"]) + len(e["sizes"]) for e in entries.to_pylist()) == 2 * slices


def test_slices_alike_by_chance_lose_no_link(spark, store, monkeypatch):
    """Hashes of slices that tell nothing make more candidates, not other links."""
    of_sets = jaccard_join._grid_array

    def blank(sets):
        return of_sets([[(tag, n, hashes * 0, sizes, least) for tag, n, hashes, sizes, least in own] for own in sets])

    monkeypatch.setattr(jaccard_join, "_grid_array", blank)
    rows = corpus(5, range(20, 60, 4), 5, 6)
    docs = store(spark, rows, SCHEMA)
    assert result(jaccard_join.jaccard_join(docs, shingle_words=4, percent=85)) == by_hand(rows, 4, 85)


def test_cost_chooses_the_boundary():
    plan = jaccard_join.Plan(85)
    assert 7 <= plan.boundary({size: 10 for size in range(1, 24)}) <= 13
    assert plan.subsets(5, 20) == 0 and plan.subsets(7, 20) == 8 and plan.subsets(14, 20) == 106
    crowded = plan.boundary({22: 1000})
    assert crowded < 19         # subsets of 19 and more of 22 would be 1794 a set


def test_defined_cases(spark, store):
    long = " ".join(f"w{i}" for i in range(120_000))
    rows = [(5, long, 1), (4, long + " end", 1), (3, None, 1), (None, "", 1), (7, "a", 1), (7, "A", 1),
            (None, "b c", 1), (2, "b c", 1)]
    docs = store(spark, rows, SCHEMA + ", node int")
    out = jaccard_join.jaccard_join(docs)
    assert result(out) == sorted([
        (5, 119_996, 4, 5, 1, 1), (4, 119_997, 4, 4, 1, 1), (3, 0, 3, 3, 1, 0), (None, 0, None, None, 1, 0),
        (7, 1, 7, 7, 2, 0), (7, 1, 7, 7, 2, 0), (None, 1, 2, 2, 2, 0), (2, 1, 2, 2, 2, 0)], key=repr)
    assert jaccard_join.jaccard_join(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        jaccard_join.jaccard_join(docs, percent=50)


def test_query_on_stored_tables(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert result(queries.op11_jaccard_join(spark, folder)) == by_hand(rows, 4, 85)
