"""Conversation repair against a plain dynamic programme and exhaustive search."""
from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from lotwise.llm import conversation_repair as repair
from lotwise.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"
FORM = re.compile("(s?(ua)+)?")
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def cheapest(rows):
    """``(cost, letters, final roles)``: the least by cost, then by letters, of all edits, by a forward
    pass over the states.  Rows are ``(initial, has to go, truncated)``."""
    def insert(best):
        for _ in range(3):
            for state, (cost, letters, out) in list(best.items()):
                for initial in "ua":
                    after = STEP.get((state, initial))
                    if after is not None:
                        new = cost + 2, letters + "I", out + [(initial, None)]
                        best[after] = min(best.get(after, new), new, key=lambda x: x[:2])
        return best

    best = insert({0: (0, "", [])})
    for i, (initial, gone, cut) in enumerate(rows):
        after = {}

        def offer(state, cost, letters, out):
            if state is not None:
                new = cost, letters, out
                after[state] = min(after.get(state, new), new, key=lambda x: x[:2])

        for state, (cost, letters, out) in best.items():
            offer(state, cost + 3, letters + "D", out)
            if not gone:
                offer(STEP.get((state, initial)), cost + cut, letters + "K", out + [(None, i)])
                for role in "ua":
                    offer(STEP.get((state, role)), cost + 2 + cut, letters + "R", out + [(role, i)])
        best = insert(after)
    return min((best[s] for s in (0, 3) if s in best), key=lambda x: x[:2])


def expected(rows):
    """The contract's row of a conversation's ``(turn, role, text)`` after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1],
                                       hashlib.sha256(r[2].encode()).digest()))
    seen, symbols, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = ("blank" if not body else "duplicate" if (role, text) in seen
                 else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        symbols.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    cost, letters, out = cheapest(symbols)
    names = {"u": "user", "a": "assistant"}
    lines = [f"{names[role] if role else rows[i][1]}:{'' if i is None else rows[i][2]}" for role, i in out]
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(symbols))
    return (gaps, *faults.values(), illegal, cost, letters,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def test_plain_programme_is_cheapest():
    """All edit sequences of short conversations, written out."""
    rng = random.Random(2)
    for _ in range(150):
        rows = [(rng.choice("suax"), rng.random() < 0.2, rng.random() < 0.3)
                for _ in range(rng.randrange(0, 4))]
        found = []
        for length in range(len(rows), len(rows) + 5):
            for letters in itertools.product("DIKR", repeat=length):
                if sum(x != "I" for x in letters) != len(rows):
                    continue
                cost, roles, i = 0, [""], 0
                for x in letters:
                    cost += {"D": 3, "I": 2, "K": 0, "R": 2}[x]
                    if x in "IR":
                        roles = [r + new for r in roles for new in "ua"]
                    if x == "K":
                        roles = [r + rows[i][0] for r in roles]
                    if x != "I":
                        if x != "D" and rows[i][1]:
                            break
                        cost += x != "D" and rows[i][2]
                        i += 1
                else:
                    if any(FORM.fullmatch(r) for r in roles):
                        found.append((cost, "".join(letters)))
        assert min(found) == cheapest(rows)[:2]


def rows_of(rng, n):
    texts = ["Yes.", "No!", "why", "", " \t", "so be it", "Good?\n", "x "]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", " "]
    return [(rng.choice([None, *range(12), *range(12)]), rng.choice(roles),
             rng.choice(texts + [f"Text {rng.randrange(400)}."] * 12)) for _ in range(n)]


def plain(out):
    return {r["conv_id"]: tuple(r)[1:] for r in out.collect()}


def test_runs_and_powers_equal_single_steps():
    rng = random.Random(3)
    for _ in range(200):
        symbols = [rng.randrange(9) for _ in range(rng.randrange(1, 5)) for _ in range(rng.randrange(1, 40))]
        rows = [(s, 1) for s in symbols]
        runs, ahead = repair.collapse(rows), repair.AT_END
        single = ahead
        for s in reversed(symbols):
            single = repair.advance(s, 1, single)
        for s, n in reversed(runs):
            ahead = repair.advance(s, n, ahead)
        columns = repair.matrix(runs)
        composed = tuple(min(columns[j][i] + repair.AT_END[j] for j in range(4)) for i in range(4))
        assert ahead == single == composed
        letters, state = "", repair.START
        steps = repair.choices(runs, state, repair.AT_END)
        for s in symbols:
            if s == repair.GONE:
                letters += "D"
            else:
                before, letter, _, state = next(steps)
                letters += "I" * len(before) + letter
        letters += "I" * len(repair.closing(state))
        facts = [("", True, False) if s == repair.GONE else (*repair.SYMBOLS[s][:1], False, repair.SYMBOLS[s][1])
                 for s in symbols]
        assert (single[0], letters) == cheapest(facts)[:2]


def test_conversations_equal_brute_force(spark, store):
    """One conversation holds most rows and goes over all partitions."""
    rng = random.Random(4)
    convs = {i: rows_of(rng, rng.randrange(1, 14)) for i in [*range(40), None]}
    convs[17] = [(i // 2, *row[1:]) for i, row in enumerate(rows_of(rng, 900))]
    rows = [(conv, *row) for conv, held in convs.items() for row in held]
    out = plain(repair.transcripts(store(spark, rows, SCHEMA)))
    assert out == {conv: expected(held) for conv, held in convs.items()}


def test_repaired_conversations_have_the_form(spark, store):
    rng = random.Random(5)
    rows = [(i, *row) for i in range(60) for row in rows_of(rng, 9)]
    table = store(spark, rows, SCHEMA)
    turns = {}
    for r in sorted(repair.repaired_turns(table).collect()):
        turns.setdefault(r["conv_id"], []).append(r)
    hashes = {r["conv_id"]: r["repaired_sha256"] for r in repair.transcripts(table).collect()}
    for conv, told in hashes.items():
        mine = turns.get(conv, [])
        assert [r["turn"] for r in mine] == list(range(len(mine)))
        assert FORM.fullmatch("".join(r["role"][:1] for r in mine))
        text = "\n".join(f"{r['role']}:{r['text']}" for r in mine)
        assert hashlib.sha256(text.encode()).hexdigest() == told


def test_defined_cases(spark, store):
    long = "word " * 200_000 + "."
    rows = [(1, 0, None, None, "x"), (2, None, "user", "Hi.", "x"), (2, 5, "assistant", long, "x"),
            (2, 9, "assistant", long, "x"), (3, None, "user", None, "x"), (None, 1, "user", "Hi.", "x")]
    rows += [(4, 0, "user", "Same.", "x")] * 3000
    table = store(spark, rows, SCHEMA + ", symbol string")
    out = plain(repair.transcripts(table))
    assert out[1][:7] == (0, 1, 0, 0, 0, 3, "D")
    assert out[2][:7] == (3, 0, 1, 0, 1, 3, "KKD")
    assert out[3][:7] == (0, 1, 0, 0, 0, 3, "D")
    assert out[None][:7] == (0, 0, 0, 0, 0, 2, "KI")
    assert out[4][:7] == (0, 0, 2999, 0, 2999, 3 * 2999 + 2, "K" + "D" * 2999 + "I")
    assert out == {c: expected([(r[1], r[2] or " ", r[3] or " ") for r in rows if r[0] == c])
                   for c in out}
    assert repair.transcripts(table.limit(0)).count() == 0
    assert repair.repaired_turns(table.limit(0)).count() == 0
    strings = table.withColumn("conv_id", table.conv_id.cast("string"))
    assert plain(repair.transcripts(strings))["2"] == out[2]


def by_contract(rows):
    convs = {}
    for conv, turn, role, text in rows:
        held = convs.setdefault(conv, [])
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        if fate:
            held += [(turn, role, text)] * (2 if fate == 3 else 1)
    return {conv: expected(held) for conv, held in convs.items()}


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, *row) for i in [*range(150), None] for row in rows_of(rng, rng.randrange(1, 10))]
    rows += [(1000 + i, 0, "user", "Hi.") for i in range(60)]        # some lose their only row
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    out = plain(queries.op12_conversation_repair(spark, str(tmp_path)))
    assert out == by_contract(rows)
    assert (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in out.values()


@pytest.mark.parametrize("scale", ["sf0.001"])
def test_query_on_stored_tables(spark, scale):
    folder = f"/root/testdata/{scale}"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert plain(queries.op12_conversation_repair(spark, folder)) == by_contract(rows)


def test_sql_equals_brute_force():
    import duckdb

    from lotwise.llm.oracles import ORACLE

    rng = random.Random(7)
    rows = [(i, *row) for i in [*range(120), None] for row in rows_of(rng, rng.randrange(1, 10))]
    db = duckdb.connect()
    db.sql("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    db.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    found = db.sql(ORACLE["op12_conversation_repair"]).fetchall()
    assert {r[0]: r[1:] for r in found} == by_contract(rows)
