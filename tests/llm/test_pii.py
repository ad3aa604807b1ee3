"""Base spans against Python's regular expressions; bootstrapped contexts."""
import random

import brute
import pytest

from lotwise.llm import pii

ATOMS = list("ab1239.@@.-+ ()_%é😀\n:=") + [
    "a@b.c", "a@b.c_d@e.f", "1.2.3.4", "255.255.0.1", "1.2.3.4.5.6.7.8", "4321720528180570",
    "4111 1111 1111 1111", "+1 (846) 555-5432", "+49 30 123456", "0000.1.2.3", "999.1.1.1",
    "email: ", "phone="]


def written(row, base_only=True):
    return [f"{pii.KINDS[s.kind]}:{s.start}:{s.end}" for s in row.spans if s.base or not base_only]


def plan_is_native(df):
    plan = df._jdf.queryExecution().toString()
    return not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_base_spans_match_brute_force(spark, store):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(ATOMS) for _ in range(rng.randint(0, 40))), "x")
            for i in range(1500)]
    rows += [(5000, None, None), (5001, "", ""), (5002, "1.2.3.4 " * 300, "y")]
    out = pii.find_pii(store(spark, rows, "doc_id long, text string, spans string"))
    assert plan_is_native(out)
    got = {r.doc_id: written(r) for r in out.collect()}
    assert got == {i: brute.pii(t) for i, t, _ in rows}


def test_very_long_runs_end(spark, store):
    rows = [(1, "a" * 200000), (2, "1." * 50000), (3, "a@b" + ".c" * 50000),
            (4, "+1" + " " * 100000), (5, "1 " * 50000), (6, "a@" * 50000)]
    out = {r.doc_id: written(r) for r in pii.find_pii(
        store(spark, rows, "doc_id long, text string")).collect()}
    assert out[1] == [] and out[4] == [] and out[6] == []
    assert len(out[2]) == 12500 and out[3] == ["email:0:100003"]


def test_bootstrapping_finds_unseen_identifiers(spark, store):
    rows = [(i, f"some text, e-mail: user{i}@mail{i}.example.com and so on") for i in range(30)]
    rows += [(100, "write to e-mail: user7(at)host or not"), (101, "E-Mail: joe9 at home"),
             (102, "code: x17 and ticket=88"), (103, "e-mail: user1@mail1.example.com"),
             # a second label is learnt through an instance of the first
             (104, "e-mail: agent77"), (105, "handle=agent77"), (106, "handle=agent78")]
    rows += [(200 + i, f"handle=user{i}@mail{i}.example.com") for i in range(8)]
    out = {r.doc_id: r for r in pii.find_pii(
        store(spark, rows, "doc_id long, text string")).collect()}
    for doc, value in ((101, "joe9"), (104, "agent77"), (105, "agent77"), (106, "agent78")):
        text = dict(rows)[doc]
        at = text.index(value)
        assert written(out[doc], False) == [f"email:{at}:{at + len(value)}"]
    assert written(out[102], False) == []
    assert written(out[103], False) == written(out[103])


def test_scores_are_damped_means(spark):
    edges = spark.createDataFrame([("p", "a"), ("p", "b"), ("q", "b"), ("q", "c")],
                                  "pattern string, instance string")
    seeds = spark.createDataFrame([("a", "email")], "instance string, kind string")
    once = pii.score_patterns(edges, seeds, 1).collect()
    assert [(r.pattern, r.score) for r in once] == [("p", pytest.approx(0.5 / 1.5))]
    twice = {r.pattern: r.score for r in pii.score_patterns(edges, seeds, 2).collect()}
    assert twice["p"] == pytest.approx((1 + 1 / 3) / 2 * 2 / 2.5)
    assert twice["q"] == pytest.approx(1 / 3 / 2 * 1 / 1.5)


def test_repeated_rows_null_ids_and_empty(spark, store):
    docs = store(spark, [(None, "x@y.z"), (1, "x@y.z"), (1, "x@y.z")], "doc_id long, text string")
    assert [written(r) for r in pii.find_pii(docs).collect()] == [["email:0:5"]] * 3
    assert pii.find_pii(docs.limit(0)).count() == 0


def test_contexts_in_prose_are_learnt(spark, store):
    rows = [(i, f"You can always reach me under user{i}@mail.example.com, said {name}.")
            for i, name in enumerate("ann bob cid dan eve fay gus hal".split())]
    rows += [(100, "You can always reach me under agent77, or not"), (101, "There were 77 of 88.")]
    rows += [(200 + i, f"contact: mailbox: user{i}@mail.example.com") for i in range(8)]
    rows += [(300, "contact: mailbox: joe1")]
    out = {r.doc_id: r for r in pii.find_pii(
        store(spark, rows, "doc_id long, text string")).collect()}
    for doc, value in ((100, "agent77"), (300, "joe1")):
        at = dict(rows)[doc].index(value)
        assert written(out[doc], False) == [f"email:{at}:{at + len(value)}"]
    assert written(out[101], False) == []


def test_identifiers_with_blanks_are_whole(spark, store):
    long = "x" * 300 + "7"
    rows = [(i, f"tel: +1 (846) 555-54{10 + i}") for i in range(20)]
    rows += [(100, "tel: 0846 555 1234 now"), (101, f"tel: {long}"), (102, "tel: (030) 12-34.")]
    out = {r.doc_id: r for r in pii.find_pii(
        store(spark, rows, "doc_id long, text string")).collect()}
    assert written(out[100], False) == ["phone:5:18"]
    assert written(out[101], False) == ["phone:5:306"]
    assert written(out[102], False) == ["phone:6:16"]
    assert written(out[0], False) == written(out[0]) == ["phone:5:22"]
