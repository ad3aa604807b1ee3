"""Exact dedup, sharding and preference formatting."""
import hashlib
import zlib

import brute
from pyspark.sql import functions as F

from lotwise.llm import exact_dedup, preference, sharding
from lotwise.llm.rows import key_bitmap, may_contain

DOCS = "doc_id long, text string, size string, KEEP_ID int"


def plans_without_python(df):
    plan = df._jdf.queryExecution().toString()
    return not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def doc_rows(words):
    long = words(1, 20000)
    texts = [words(2, 30), words(2, 30).upper(), words(3, 30), "", None, "É", "é", long, long,
             long[:-1] + "x", "same", "SAME", "other", "samE"]
    return [(i, t, "x", 1) for i, t in enumerate(texts)]


def test_exact_dedup_matches_brute_force(spark, store, words):
    rows = doc_rows(words)
    out = exact_dedup.exact_dedup(store(spark, rows, DOCS))
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in out.collect()}
    want = brute.exact([r[:2] for r in rows])
    assert got == {i: (k, n, k == i) for i, (k, n) in want.items()}
    assert plans_without_python(out)


def test_exact_dedup_full_filters_lose_nothing(spark, store, words):
    rows = doc_rows(words)
    out = exact_dedup.exact_dedup(store(spark, rows, DOCS), prefix_chars=1, filter_bits=64)
    got = {r.doc_id: (r.keep_id, r.group_size) for r in out.collect()}
    assert got == brute.exact([r[:2] for r in rows])


def test_exact_dedup_null_and_repeated_ids(spark, store):
    rows = [(None, "a"), (None, "A"), (3, "b"), (3, "b"), (None, "b"), (4, None), (4, "")]
    out = exact_dedup.exact_dedup(store(spark, rows, "doc_id long, text string")).collect()
    assert len(out) == 7
    assert sum(r.kept for r in out) == 3
    assert {r.keep_id for r in out if r.group_size == 3} == {3}
    assert {r.keep_id for r in out if r.doc_id is None and r.group_size == 2} == {None}


def test_drop_copies_keeps_columns_and_empty_table(spark, store):
    docs = store(spark, [(1, "a", "r", 1), (2, "A", "s", 2), (None, None, None, None)],
                 "doc_id long, text string, row_id string, kept int")
    assert sorted(map(tuple, exact_dedup.drop_copies(docs).collect()), key=repr) == sorted(
        [(2, "A", "s", 2), (None, None, None, None)], key=repr)
    assert exact_dedup.drop_copies(docs.limit(0)).columns == docs.columns
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0


def test_key_bitmap_contains_its_keys(spark):
    keys = spark.range(0, 1000, 7)
    all_ = spark.range(1000)
    bits = 1 << 14
    passed = {r.id for r in all_.where(
        may_contain(key_bitmap(keys, ["id"], bits), [F.col("id")], bits)).collect()}
    assert passed >= set(range(0, 1000, 7))
    assert len(passed) < 400


def shard_rows(out):
    return sorted((r.shard, r.slot, r.doc_id, r.size, r.text_crc32) for r in out.collect())


def test_byte_shards_follow_prefix_sums(spark, store, words):
    rows = [(i * 3, None if i % 17 == 0 else words(i, i % 40), "x", 1) for i in range(400)]
    out = sharding.byte_shards(store(spark, rows, DOCS, 7), 24)
    assert plans_without_python(out)
    got = {r.doc_id: (r.shard, r.slot, r.size, r.text_crc32) for r in out.collect()}
    sizes = [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))
             for i, t, *_ in rows]
    total, before, slots = sum(s for _, s, _ in sizes), 0, {}
    for i, s, c in sizes:
        shard = min(23, (2 * before + s) * 24 // (2 * total))
        assert got[i] == (shard, slots.get(shard, 0), s, c)
        slots[shard] = slots.get(shard, 0) + 1
        before += s


def test_byte_shards_repeated_and_null_ids(spark, store):
    rows = [(7, "same")] * 200 + [(None, "x")] * 100 + [(1, None)] * 3
    got = shard_rows(sharding.byte_shards(store(spark, rows, "doc_id long, text string", 5), 24,
                                          partitions=9))
    assert len(got) == 303
    by_shard = {}
    for shard, slot, *_ in got:
        by_shard.setdefault(shard, []).append(slot)
    assert all(s == list(range(len(s))) for s in by_shard.values())
    assert max(map(len, by_shard.values())) < 20
    empty = store(spark, rows, "doc_id long, text string").limit(0)
    assert sharding.byte_shards(empty).count() == 0


TURNS = "conv_id long, turn long, role string, text string, turns string"


def test_preferences_share_one_prompt(spark, store):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello there"), (1, 2, "user", "bye"),
            (2, 0, "user", "hi"), (2, 1, "assistant", "hello"),
            (3, 0, "user", "hi"), (3, 1, "assistant", "hello there"), (3, 2, "user", "why"),
            (4, 0, "system", "be kind"), (4, 1, "assistant", None), (4, None, "user", "first"),
            (None, 0, "user", "lost"), (5, 0, "user", "hi")]
    turns = store(spark, [(*r, "x") for r in rows], TURNS)
    convs = preference.conversations(turns)
    out = preference.format_preferences(preference.pairs_by_opening(convs), convs)
    assert plans_without_python(out)
    got = {(r.chosen_id, r.rejected_id): r for r in out.collect()}
    assert set(got) == {(1, 2), (1, 3), (1, 5), (4, None)}
    r = got[1, 3]
    assert r.n_prompt_turns == 2
    assert r.prompt == "<|user|>\nhi\n<|assistant|>\nhello there\n"
    assert [tuple(x) for x in r.chosen] == [("<|user|>\nbye\n", False)]
    assert [tuple(x) for x in r.rejected] == [("<|user|>\nwhy\n", False)]
    assert [tuple(x) for x in got[1, 2].rejected] == [("<|assistant|>\nhello\n", True)]
    assert got[1, 5].n_prompt_turns == 1 and got[1, 5].rejected == []
    alone = got[4, None]
    assert alone.rejected is None and alone.prompt == "<|user|>\nfirst\n<|system|>\nbe kind\n"
    assert [x.train for x in alone.chosen] == [True]


def test_preferences_equal_conversations_and_empty(spark, store):
    rows = [(i, t, r, x, "") for i in range(40)
            for t, r, x in ((0, "user", "q"), (1, "assistant", "a" * 1000))]
    convs = preference.conversations(store(spark, rows, TURNS))
    out = preference.format_preferences(preference.pairs_by_opening(convs), convs).collect()
    assert len(out) == 39
    assert all(r.chosen_id == 0 and r.n_prompt_turns == 2 and not r.chosen and not r.rejected
               for r in out)
    none = preference.conversations(store(spark, rows, TURNS).limit(0))
    assert preference.format_preferences(preference.pairs_by_opening(none), none).count() == 0


def test_checksum_of_query_contract(spark, store):
    docs = store(spark, [(1, "AbÉ"), (2, None)], "doc_id long, text string")
    out = exact_dedup.exact_dedup(
        docs, carry={"h": F.sha2(exact_dedup.normalised(F.col("text")), 256)})
    assert {r.doc_id: r.h for r in out.collect()} == {
        1: hashlib.sha256("abÉ".encode()).hexdigest(), 2: hashlib.sha256(b"").hexdigest()}


def test_opening_turns_are_told_apart(spark, store):
    """Ids of any type; a role's end is no part of its text."""
    rows = [("a", 0, "user", "x\n"), ("b", 0, "user\nx", ""), ("c", 0, "user", "x\n"),
            ("c", 1, "assistant", "more"), ("d", 0, "user", "x\n"), ("d", 1, "assistant", "less")]
    convs = preference.conversations(store(spark, rows, "conv_id string, turn long, role string, text string"))
    pairs = preference.pairs_by_opening(convs)
    assert sorted(map(tuple, pairs.collect()), key=repr) == [("b", None), ("c", "a"), ("c", "d")]
    out = {r["rejected_id"]: r for r in preference.format_preferences(pairs, convs).collect()}
    assert out["d"]["n_prompt_turns"] == 1 and out[None]["prompt"] == "<|user\nx|>\n\n"
