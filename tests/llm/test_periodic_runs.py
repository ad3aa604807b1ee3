"""Recompression grammar and periodic runs against brute force."""
from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from lotwise.llm import periodic_runs, queries
from lotwise.llm.recompression import Grammar

SCHEMA = "doc_id long, text string"


def runs_by_hand(words, min_length=24, min_exponent=3):
    """Every maximal stretch of equal words q apart, for each q; of one stretch the least q."""
    n, found = len(words), {}
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(min_length, min_exponent * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


def repeated(rng, kinds, n):
    words = [rng.choice(kinds) for _ in range(n)]
    if n and rng.random() < 0.7:
        a, p = rng.randrange(n), rng.randrange(1, n // 3 + 2)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if rng.random() < 0.4:
            words[rng.randrange(n)] = "odd"
    return words


def test_extensions_equal_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(60):
        texts, parts = int(rng.integers(1, 4)), [np.array([0])]
        for i in range(texts):
            text = rng.integers(0, rng.integers(1, 4), rng.integers(0, 40))
            if len(text) and rng.random() < 0.5:
                text = text[np.arange(len(text)) % rng.integers(1, len(text) + 1)]
            parts += [text + texts + 1, np.array([i + 1])]
        symbols = np.concatenate(parts)
        a, b = np.triu_indices(len(symbols), 1)
        grammar = Grammar(symbols, texts + 1)
        for step in (1, -1):
            expected = []
            for x, y in zip(a.tolist(), b.tolist()):
                n = 0
                while 0 <= x + step * n and y + step * n < len(symbols) and (
                        symbols[x + step * n] == symbols[y + step * n]):
                    n += 1
                expected.append(n)
            inside = (a > 0) if step < 0 else np.ones(len(a), bool)
            assert (grammar.extend(a[inside], b[inside], step) == np.array(expected)[inside]).all()


def test_one_level_of_long_blocks_suffices_for_a_repeated_word():
    text = np.concatenate([[0], np.full(100_000, 2), [1]])
    grammar = Grammar(text, 2)
    assert len(grammar.levels) == 1 and grammar.levels[0].blocks
    assert grammar.extend(np.array([1]), np.array([2]), 1).tolist() == [99_999]


@pytest.mark.parametrize("limits", [(24, 3), (6, 3), (4, 2)])
def test_runs_equal_brute_force(limits):
    rng = random.Random(7)
    texts = [repeated(rng, "abcd"[:rng.randrange(1, 5)], rng.randrange(0, 160)) for _ in range(150)]
    found = periodic_runs.runs_of([[w.encode() for w in t] for t in texts], *limits)
    for text, runs in zip(texts, found):
        assert [tuple(r) for r in runs.tolist()] == runs_by_hand(text, *limits)


def test_defined_cases(spark, store):
    """Nulls, no words, other white space, a very long text, repeated rows, extra columns."""
    long = " ".join(["x", "y"] * 40_000)
    rows = [(1, None, 7), (2, "", 7), (3, " \t\n ", 7), (4, "\u00a0a\u00a0a", 7), (None, "a " * 30, 7),
            (5, "a\u000b" * 23, 7), (6, "a " * 24, 7), (6, "a " * 24, 7), (7, long, 7)]
    docs = store(spark, rows, SCHEMA + ", best int")
    out = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"], r["best"])
           for r in periodic_runs.find_runs(docs).collect()]
    assert sorted(out, key=repr) == sorted([
        (1, 0, [], "", 7), (2, 0, [], "", 7), (3, 0, [], "", 7), (4, 1, [], "\u00a0a\u00a0a", 7),
        (None, 30, [(0, 30, 1)], "a", 7), (5, 23, [], " ".join(["a"] * 23), 7),
        (6, 24, [(0, 24, 1)], "a", 7), (6, 24, [(0, 24, 1)], "a", 7),
        (7, 80_000, [(0, 80_000, 2)], "x y", 7)], key=repr)
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="runs"):
        periodic_runs.find_runs(docs.withColumnRenamed("best", "Runs"))


def by_contract(doc_id, text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    n = len(words)
    if doc_id is not None:
        g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
        if rest == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = runs_by_hand(words)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    return (doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            sha("".join("%d,%d,%d\n" % r for r in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(11)
    rows = [(i, rng.choice([" ", "\n", " \t"]).join(
        repeated(rng, ["a", "b", "cc", "D"][:rng.randrange(1, 5)], rng.randrange(0, 120))))
        for i in range(300)] + [(301, None), (None, "b " * 40), (302, "")]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op13_periodic_runs(spark, str(tmp_path)).collect()
    assert (sorted((tuple(r) for r in out), key=repr)
            == sorted((by_contract(*r) for r in rows), key=repr))
    assert sum(r["n_runs"] > 0 for r in out) > 50
