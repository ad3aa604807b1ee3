"""Benchmark decontamination, near-duplicate components, connected components."""
import random

import brute
import numpy as np
import pytest

from lotwise.llm import decontaminate, near_dedup, shingles
from lotwise.llm.components import components

DOCS = "doc_id long, text string, row_id string, SPAN int"


def benchmark_rows(words):
    return [(1, words("b1", 40)), (2, words("b2", 13)), (3, words("b3", 7)), (4, words("b4", 5)),
            (5, "Solo"), (6, ""), (7, None), (8, words("b1", 40)), (None, words("b9", 20)),
            (10, "É x2 " + words("b10", 15)), (10, words("b11", 14))]


def contaminated_rows(words):
    items = dict(benchmark_rows(words))
    base = [words(("d", i), 80) for i in range(12)]
    rng = random.Random(4)

    def insert(text, span):
        w = text.split()
        at = rng.randint(0, len(w))
        return " ".join(w[:at] + [span] + w[at:])

    part = items[1].split()
    texts = [base[0], insert(base[1], items[1].upper()), insert(base[2], " ".join(part[5:18])),
             insert(base[3], " ".join(part[5:17])), insert(base[4], items[2].replace(" ", ", ")),
             insert(base[5], items[3]), insert(base[6], items[4]), insert(base[7], "solo"),
             insert(insert(base[8], items[None]), items[10]), items[2], "solo", "", None,
             insert(words("long", 30000), items[1]), (items[3] + " ") * 50, "ta " * 500,
             insert(base[1], items[1]), " ".join([items[2]] * 3)]
    return [(i, t, "x", 1) for i, t in enumerate(texts)]


def test_decontamination_matches_brute_force(spark, store, words):
    rows, items = contaminated_rows(words), benchmark_rows(words)
    out = decontaminate.decontaminate(
        store(spark, rows, DOCS), store(spark, items, "item_id int, text string"))
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows)
    for doc, (n, at, found) in brute.hits([r[:2] for r in rows], items).items():
        r = got[doc]
        assert (r.n_words, r.n_hit, r.item_ids) == (n, len(at), found), doc
        assert sorted(x for s in r.spans for x in range(s.start, s.end)) == sorted(at)
        assert r.contaminated == (len(at) > 0 and 20 * len(at) >= n)
    assert any(r.contaminated for r in got.values())


def test_decontamination_with_a_full_filter(spark, store, words):
    rows, items = contaminated_rows(words)[:9], benchmark_rows(words)
    out = decontaminate.decontaminate(store(spark, rows, DOCS),
                                      store(spark, items, "item_id int, text string"),
                                      filter_bits=64).collect()
    want = brute.hits([r[:2] for r in rows], items)
    assert {r.doc_id: r.n_hit for r in out} == {i: len(at) for i, (_, at, _) in want.items()}


def test_decontamination_empty_tables(spark, store, words):
    docs = store(spark, contaminated_rows(words)[:3], DOCS)
    none = store(spark, [(1, "x")], "item_id int, text string").limit(0)
    clean = decontaminate.decontaminate(docs, none).collect()
    assert [(r.n_hit, r.item_ids, r.contaminated) for r in clean] == [(0, [], False)] * 3
    items = store(spark, benchmark_rows(words), "item_id int, text string")
    assert decontaminate.decontaminate(docs.limit(0), items).count() == 0
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {0}


def test_winnowing_guarantee():
    rng = np.random.default_rng(5)
    shared = rng.integers(1, 1 << 60, 13).astype(np.uint64)
    for _ in range(50):
        marks = []
        for _ in range(2):
            before, after = (rng.integers(1, 1 << 60, rng.integers(0, 30)).astype(np.uint64)
                             for _ in "ab")
            text = np.concatenate([before, shared, after])
            at, gram = decontaminate.winnow(text, np.zeros(len(text), int), 5, 13)
            inside = (at >= len(before)) & (at <= len(before) + 8)
            marks.append(set(gram[inside].tolist()))
        assert marks[0] & marks[1]


@pytest.mark.parametrize("cut", [1 << 20, 50])
def test_word_hashes_do_not_depend_on_cuts(monkeypatch, cut):
    texts = ["The cat", "", "  ", "the CAT sat, é", "x" * 300 + " the", "cat"]
    monkeypatch.setattr(shingles, "SEGMENT_BYTES", cut)
    hashes, bounds = shingles.words([t.encode() for t in texts], near_dedup.WORD)
    own = [hashes[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    assert [len(x) for x in own] == [len(brute.SPACE_WORD.findall(t)) for t in texts]
    assert own[0] == own[3][:2] and own[4][1] == own[0][0] and own[5][0] == own[0][1]


def near_rows(words):
    rng = random.Random(6)
    rows, texts = [], []
    for g in range(6):
        base = words(("n", g), 60).split()
        for _ in range(8):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = words(("e", rng.random()), 1)
            texts.append(" ".join(w))
    texts += [None, "", " \n", "one two", "ONE two", "one two three", "x " * 5000,
              words("big", 20000), words("big", 20000) + " more", words("solo", 50)]
    texts += [texts[0].upper()] * 3
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    return rows


@pytest.mark.parametrize("size", [4, 5])
def test_near_dedup_matches_brute_force(spark, store, words, size):
    rows = near_rows(words)
    got = {r.doc_id: r for r in near_dedup.near_dedup(
        store(spark, rows, DOCS), shingle_words=size).collect()}
    want = brute.near([r[:2] for r in rows], size)
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.kept for i, r in got.items()} == {i: i == c for i, c in want.items()}
    assert all(r.n_shingles == len(brute.shingles(rows[i][1], size)) for i, r in got.items())


def test_near_dedup_small_blocks_and_full_filter(spark, store, words, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 2)
    rows = near_rows(words)
    got = near_dedup.near_dedup(store(spark, rows, DOCS), shingle_words=4, filter_bits=64)
    assert {r.doc_id: r.component_id for r in got.collect()} == brute.near(
        [r[:2] for r in rows], 4)


def test_near_dedup_group_around_the_threshold(spark, store, words):
    """Many similar documents of which some pairs just reach the threshold."""
    rng, base, rows = random.Random(11), words("g", 120).split(), []
    for i in range(150):
        w = list(base)
        for at in rng.sample(range(len(w)), rng.randint(0, 9)):
            w[at] = words(("g", i, at), 1)
        rows.append((i, " ".join(w), "x", 1))
    want = brute.near([r[:2] for r in rows], 4)
    assert 5 < len(set(want.values())) < 145
    got = near_dedup.near_dedup(store(spark, rows, DOCS), shingle_words=4).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_near_dedup_sends_full_sets_of_close_rows_only(spark):
    """Of a band's rows in different components, those that no sketch leaves a chance go no further."""
    rng = np.random.default_rng(3)
    own = [np.sort(rng.integers(1, 1 << 63, 60).astype(np.uint64)) for _ in range(40)]
    own.append(np.sort(np.concatenate([own[0][2:], rng.integers(1, 1 << 63, 2).astype(np.uint64)])))
    samples = near_dedup.signatures(own)
    sketches = near_dedup.odd_sketches(samples).view(np.int64).tolist()
    bands = [[7] + [100 * n + i for i in range(1, near_dedup.BANDS)] for n in range(len(own))]
    full = spark.createDataFrame(
        [(n, k, b, bytearray(o.tobytes())) for n, (k, b, o) in enumerate(zip(sketches, bands, own))],
        "node long, sketch array<long>, bands array<long>, shingles binary")
    members = full.selectExpr("7L AS band", "node", "node AS label")
    slim = members.join(full.selectExpr("node", "sketch", "bands", "60L AS size"), "node").selectExpr(
        "band", "0 AS low", "0 AS high", "0 AS own", "node", "label", "sketch", "bands", "size")
    near = near_dedup._by_block(slim, near_dedup._near_in_block, 80,
                                "band long, low int, high int, own int, node long, label long")
    assert {r["node"] for r in near.collect()} == {0, 40}
    links = near_dedup._links_across(members, full, 80).collect()
    assert [{r["a"], r["b"]} for r in links] == [{0, 40}]


def test_near_dedup_null_and_repeated_ids(spark, store, words):
    text = words(9, 40)
    rows = [(None, text), (None, text + " end"), (7, text), (7, text), (5, text), (None, words(8, 9))]
    docs = store(spark, rows, "doc_id long, text string")
    out = near_dedup.near_dedup(docs).collect()
    assert sorted([(r.component_id, r.kept) for r in out], key=repr) == sorted(
        [(5, True)] + [(5, False)] * 4 + [(None, True)], key=repr)
    assert near_dedup.drop_near_copies(docs).count() == 2
    assert near_dedup.near_dedup(docs.limit(0)).count() == 0


def test_odd_sketch_estimates_differing_samples():
    rng = np.random.default_rng(7)
    samples = rng.integers(0, 1 << 32, (400, near_dedup.BANDS * near_dedup.ROWS)).astype(np.uint32)
    other = samples.copy()
    other[:, :32] = rng.integers(0, 1 << 32, (400, 32))
    count = np.bitwise_count(near_dedup.odd_sketches(samples)
                             ^ near_dedup.odd_sketches(other)).sum(axis=1)
    bits = near_dedup.SKETCH_BITS
    estimate = -bits / 4 * np.log(1 - 2 * count / bits)
    assert abs(estimate.mean() - 32) < 1
    assert (count <= near_dedup.max_count()).all()
    assert (near_dedup.odd_sketches(samples) == near_dedup.odd_sketches(samples.copy())).all()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 300)] + [(7, 500)]
    random.Random(8).shuffle(links)
    out = {r.node: r.label for r in components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    assert {out[i] for i in range(41)} == {0} and out[500] == 0
    assert {out[i] for i in range(100, 400)} == {100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
