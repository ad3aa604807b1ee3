"""Conversation structure repair: the cheapest edits that give a conversation its form.

A conversation's roles have to read ``(s?(ua)+)?`` by their initials (system, user, assistant).  The
rows are taken by turn (nulls first), then role, then the SHA-256 of the text.  A row's first fault
counts: blank (nothing but ASCII white space), duplicate (role and text seen before in
the conversation), truncated (doesn't end in ``.``, ``!`` or ``?``).  Edits: Keep 0, Rerole to user or
assistant 2, Delete 3 (required of blank and duplicate rows), Insert an empty user or assistant row
2; a truncated row that stays costs 1.  Of the cheapest sequences the one whose letters D, I, K, R
are least in ASCII is taken.

Method.  Reading the form is an automaton of four states; a row (its insertions before it included)
is a 4 x 4 matrix of costs under (min, +) that depends on its symbol only: the initial's class and
the fault.

1. Rows become narrow: texts are replaced by their SHA-256, equal rows by one with a count, duplicates are
   told by an aggregate on (conversation, role, text).  The narrow rows are range-partitioned in reading
   order and checkpointed, so a conversation of any length is cut into fragments.
2. Equal consecutive symbols are collapsed into runs.  A run of n is advanced by the cached powers
   M, M^2, M^4, ... of its matrix.  Only the first and the last conversation of a partition can
   go on in another one; their fragments' matrices, two for each partition, are composed
   on the driver, which gives the cost to go behind each fragment, and then the state before it.
3. With the cost to go known, choices are unrolled from the front: the least letter that keeps the
   total cheapest.  Runs are unrolled by halves, so a long one takes no memory.  Insertions and
   deletions commute and D < I, so required deletions stay runs: a count, not letters.

``transcripts`` and ``repaired_turns`` bring texts and edits together: both are sorted within a
conversation and read as a stream.  A SHA-256 is sequential, so one task reads one conversation's
texts there, row by row without holding them.

Defined cases: a null role or text counts as one space (so a null text is blank); a null conversation id is a
conversation; null turns come first and don't count in ``gaps``; equal rows are duplicates of the
first; a role of another initial, or an empty one, has to be reroled or deleted; very long texts are only
hashed; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

from functools import cache
from hashlib import sha256
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, LongType, StructType

from lotwise.llm.rows import shuffle_partitions
from lotwise.session import checkpoint_dir

NEVER = 1 << 60
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States: nothing read, system read, a user's turn read, an assistant's turn read.
START = 0
#: The state after each initial that may follow, and the one role that can be put there.
FOLLOWS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
FITS = ("u", "u", "a", "u")
ROLES = {"u": "user", "a": "assistant"}
#: Initials that may stand next to each other.
LEGAL = ("su", "ua", "au")
COST = {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}
#: Cost to go at the end: what has to be inserted there.
AT_END = (0, 2 * INSERT, INSERT, 0)
#: Symbols: (initial, truncated), and one for rows that have to go.
SYMBOLS = [(initial, cut) for initial in ("s", "u", "a", "") for cut in (False, True)]
GONE = len(SYMBOLS)


def _product(x, y):
    return tuple(tuple(min(x[i][k] + y[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def _insertions():
    one = tuple(tuple(0 if i == j else INSERT if FOLLOWS[i][FITS[i]] == j else NEVER
                      for j in range(4)) for i in range(4))
    return _product(one, one)


@cache
def power(symbol: int, exponent: int):
    """The matrix of ``2 ** exponent`` rows of one symbol."""
    if exponent:
        half = power(symbol, exponent - 1)
        return _product(half, half)
    row = [[NEVER] * 4 for _ in range(4)]
    for state in range(4):
        row[state][state] = DELETE
        if symbol != GONE:
            initial, cut = SYMBOLS[symbol]
            stays = TRUNCATED if cut else 0
            after = FOLLOWS[state][FITS[state]]
            row[state][after] = min(row[state][after], REROLE + stays)
            after = FOLLOWS[state].get(initial)
            if after is not None:
                row[state][after] = min(row[state][after], stays)
    return _product(_insertions(), row)


def advance(symbol: int, n: int, ahead: tuple) -> tuple:
    """Cost to go before ``n`` rows of a symbol, from that behind them."""
    exponent = 0
    while n:
        if n & 1:
            m = power(symbol, exponent)
            a, b, c, d = ahead
            ahead = tuple(min(r[0] + a, r[1] + b, r[2] + c, r[3] + d) for r in m)
        n >>= 1
        exponent += 1
    return ahead


def collapse(rows) -> list[list[int]]:
    """Runs ``[symbol, n]`` of rows ``(symbol, copies)``; copies of a row have to go."""
    runs: list[list[int]] = []
    for symbol, copies in rows:
        for s, n in ((symbol, 1), (GONE, copies - 1)):
            if n and runs and runs[-1][0] == s:
                runs[-1][1] += n
            elif n:
                runs.append([s, n])
    return runs


def matrix(runs) -> list[tuple]:
    """Columns of the matrix of a fragment."""
    columns = []
    for state in range(4):
        ahead = tuple(0 if i == state else NEVER for i in range(4))
        for symbol, n in reversed(runs):
            ahead = advance(symbol, n, ahead)
        columns.append(ahead)
    return columns


def _choose(symbol: int, state: int, ahead: tuple):
    """The cheapest and least edits of one row: initials inserted before it, its letter, the
    initial that it gets by a Rerole, the state behind it."""
    here = advance(symbol, 1, ahead)
    initial, cut = SYMBOLS[symbol]
    stays, inserted = TRUNCATED if cut else 0, ""
    while True:
        left, fit = here[state], FITS[state]
        after = FOLLOWS[state][fit]
        if DELETE + ahead[state] == left:
            return inserted, "D", None, state
        if INSERT + here[after] == left:
            inserted, state = inserted + fit, after
            continue
        kept = FOLLOWS[state].get(initial)
        if kept is not None and stays + ahead[kept] == left:
            return inserted, "K", None, kept
        return inserted, "R", fit, after


def _unroll(symbol: int, n: int, state: int, ahead: tuple):
    """Choices of the rows of a run."""
    if n == 1:
        choice = _choose(symbol, state, ahead)
        yield choice
        return choice[3]
    second = n // 2
    state = yield from _unroll(symbol, n - second, state, advance(symbol, second, ahead))
    return (yield from _unroll(symbol, second, state, ahead))


def choices(runs, state: int, ahead: tuple):
    """Choices of the rows that needn't go, from the front; returns the state behind."""
    behind = []
    for symbol, n in reversed(runs):
        behind.append(ahead)
        ahead = advance(symbol, n, ahead)
    for symbol, n in runs:
        ahead = behind.pop()
        if symbol != GONE:
            state = yield from _unroll(symbol, n, state, ahead)
    return state


def last_state(runs, state: int, ahead: tuple) -> int:
    steps = choices(runs, state, ahead)
    while True:
        try:
            next(steps)
        except StopIteration as end:
            return end.value


def closing(state: int) -> str:
    """Initials inserted at the end."""
    added = ""
    while AT_END[state]:
        added += FITS[state]
        state = FOLLOWS[state][FITS[state]]
    return added


# ---- narrow rows -------------------------------------------------------------------------

SPACE = " \t\n\u000b\f\r"
KEY = ["conv_id", "turn", "role", "text_key"]


def _read(convs: DataFrame, conv: str, turn: str, role: str, text: str, copies: str | None) -> DataFrame:
    texts = convs.select(
        F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        (F.lit(1) if copies is None else F.col(copies)).cast("long").alias("copies"))
    return texts.withColumn("text_key", F.unhex(F.sha2("text", 256)))


def _facts(texts: DataFrame) -> DataFrame:
    """One narrow row for equal rows: ``copies``, and the first one's ``symbol``."""
    ended = F.rtrim("text", F.lit(SPACE))
    narrow = texts.select("conv_id", "turn", "role", "text_key", "copies", (ended == "").alias("blank"),
                          (~F.substring(ended, -1, 1).isin(".", "!", "?")).alias("cut"))
    key = ["conv_id", "turn", "role", "text_key"]
    rows = narrow.groupBy(*key).agg(F.sum("copies").alias("copies"), F.first("blank").alias("blank"),
                                    F.first("cut").alias("cut"))
    # A struct with a null turn is less than one with any turn.
    first = rows.groupBy("conv_id", "role", "text_key").agg(
        F.min(F.struct("turn")).alias("first"))
    rows = rows.alias("r").join(first.alias("f"), (
        F.col("r.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("r.role") == F.col("f.role"))
        & (F.col("r.text_key") == F.col("f.text_key"))))
    seen = ~F.col("r.turn").eqNullSafe(F.col("first.turn"))
    initial = F.substring("r.role", 1, 1)
    symbol: Column = F.lit(None).cast("int")
    for number, (name, cut) in reversed(list(enumerate(SYMBOLS))):
        fits = (initial == name) if name else F.lit(True)
        symbol = F.when(fits & (F.col("cut") == F.lit(cut)), number).otherwise(symbol)
    return rows.select(
        *[F.col(f"r.{c}").alias(c) for c in key], "copies", "blank", seen.alias("seen"),
        F.when(F.col("blank") | seen, GONE).otherwise(symbol).cast("int").alias("symbol"))


# ---- fragments ---------------------------------------------------------------------------

def _fragments(batches):
    """``(conversation, rows)`` of a sorted partition; rows are ``(symbol, copies)`` and the
    Arrow row that each comes from as ``(batch, place)``."""
    conv, held, started = None, [], False
    for batch in batches:
        ids = batch.column("conv_id").to_pylist()
        symbols = batch.column("symbol").to_pylist()
        copies = batch.column("copies").to_pylist()
        for i, this in enumerate(ids):
            if started and this != conv:
                yield conv, held
                held = []
            conv, started = this, True
            held.append((symbols[i], copies[i], batch, i))
    if started:
        yield conv, held


def _with_ends(fragments):
    """``(is the first one, is the last one, conversation, rows)``"""
    previous, number = None, 0
    for fragment in fragments:
        if previous is not None:
            yield number == 1, False, *previous
        previous, number = fragment, number + 1
    if previous is not None:
        yield number == 1, True, *previous


def _runs(rows):
    return collapse((row[0], row[1]) for row in rows)


def _open_ends(rows: DataFrame):
    """What the driver needs of the partitions' first and last fragments: ``(partition, is the last
    one, conversation, columns of its matrix)`` in order."""
    def run(batches):
        part = TaskContext.get().partitionId()
        for first, last, conv, held in _with_ends(_fragments(batches)):
            if first or last:
                columns = [x for column in matrix(_runs(held)) for x in column]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([last]), pa.array([conv], conv_type),
                     pa.array([columns], pa.list_(pa.int64()))],
                    names=["part", "last", "conv_id", "columns"])

    conv_type = _arrow(rows, "conv_id")
    schema = (StructType().add("part", "integer").add("last", "boolean")
              .add(rows.schema["conv_id"]))
    found = rows.mapInArrow(run, _with_longs(schema, "columns")).collect()
    return sorted(((r["part"], r["last"], r["conv_id"], r["columns"]) for r in found),
                  key=lambda end: end[:2])


def _arrow(rows: DataFrame, column: str):
    return to_arrow_type(rows.schema[column].dataType)


def _with_longs(schema: StructType, name: str) -> StructType:
    return schema.add(name, ArrayType(LongType()))


def _joined(rows: DataFrame) -> dict:
    """For each fragment of a conversation in several partitions: ``(state before it, cost to go behind
    it, is the conversation's last one)``.  There are two at most for each partition."""
    ends = _open_ends(rows)
    groups: list[list] = []
    for end in ends:
        if groups and groups[-1][-1][0] != end[0] and groups[-1][-1][2] == end[2]:
            groups[-1].append(end)
        else:
            groups.append([end])
    groups = [g for g in groups if len(g) > 1]
    behind = {}
    for group in groups:
        ahead = AT_END
        for part, last, _, columns in reversed(group):
            behind[part, last] = ahead
            ahead = tuple(min(columns[4 * j + i] + ahead[j] for j in range(4)) for i in range(4))
    if not behind:
        return {}

    def run(batches):
        part = TaskContext.get().partitionId()
        if (part, False) in behind or (part, True) in behind:
            for first, last, _, held in _with_ends(_fragments(batches)):
                ahead = behind.get((part, last)) if first or last else None
                if ahead is not None:
                    runs = _runs(held)
                    states = [last_state(runs, s, ahead) for s in range(4)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part], pa.int32()), pa.array([last]),
                         pa.array([states], pa.list_(pa.int64()))], names=["part", "last", "states"])

    schema = _with_longs(StructType().add("part", "integer").add("last", "boolean"), "states")
    moves = {(r["part"], r["last"]): r["states"] for r in rows.mapInArrow(run, schema).collect()}
    joined = {}
    for group in groups:
        state = START
        for i, (part, last, _, _) in enumerate(group):
            joined[part, last] = state, behind[part, last], i == len(group) - 1
            state = moves[part, last][state]
    return joined


def edits(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text", copies_col: str | None = None) -> DataFrame:
    """One row for each distinct row of ``convs``: ``conv_id, turn, role, text_key`` (SHA-256), ``copies``,
    ``blank``, ``seen`` (a duplicate), ``symbol``, and the edits: ``before`` (initials of the rows inserted before
    it), ``edit`` (the letter of its first copy; further ones are deleted), ``new_role``, ``after``
    (initials inserted at the end of the conversation, on its last row).

    ``copies_col`` says how often a row counts (1 or more); without it each counts once."""
    return _edits(_facts(_read(convs, conv_col, turn_col, role_col, text_col, copies_col)))


def _edits(rows: DataFrame) -> DataFrame:
    checkpoint_dir(rows.sparkSession)
    rows = (rows.repartitionByRange(shuffle_partitions(rows), *KEY)
            .sortWithinPartitions(*KEY).checkpoint())
    joined = _joined(rows)
    made = ["before", "edit", "new_role", "after"]
    schema = StructType([*rows.schema.fields])
    for name in made:
        schema = schema.add(name, "string")

    def batches_of(pending):
        first = 0
        while first < len(pending):
            batch, last = pending[first][0], first
            while last < len(pending) and pending[last][0] is batch:
                last += 1
            mine = pending[first:last]
            taken = batch.slice(mine[0][1], len(mine))
            columns = [pa.array([m[2][i] for m in mine], pa.string()) for i in range(len(made))]
            yield pa.RecordBatch.from_arrays([*taken.columns, *columns],
                                             names=[*taken.schema.names, *made])
            first = last

    def run(batches):
        part, pending = TaskContext.get().partitionId(), []
        for first, last, _, held in _with_ends(_fragments(batches)):
            whole = (START, AT_END, True)
            state, ahead, ends = joined.get((part, last), whole) if first or last else whole
            steps = choices(_runs(held), state, ahead)
            for symbol, _, batch, place in held:
                edit = ["", "D", None, ""]
                if symbol != GONE:
                    inserted, letter, role, state = next(steps)
                    edit = [inserted, letter, ROLES.get(role), ""]
                pending.append((batch, place, edit))
            if ends:
                edit[3] = closing(state)
            if len(pending) >= ROWS_AT_ONCE:
                yield from batches_of(pending)
                pending = []
        yield from batches_of(pending)

    return rows.mapInArrow(run, schema)


# ---- texts and edits together ------------------------------------------------------------

EDIT, TEXT, KNOWN = 0, 1, 2
ROWS_AT_ONCE = 2000

def _told(convs: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str,
          copies_col: str | None, known: DataFrame | None = None) -> DataFrame:
    """Edits, each with the texts of its rows behind it, in reading order within conversations.
    Each id in ``known`` has a row too."""
    texts = _read(convs, conv_col, turn_col, role_col, text_col, copies_col)
    made = _edits(_facts(texts))
    texts = texts.drop("copies").withColumn("kind", F.lit(TEXT))
    told = (made.withColumn("cut", _is_cut(F.col("symbol"))).drop("symbol")
            .withColumn("kind", F.lit(EDIT)).unionByName(texts, allowMissingColumns=True))
    if known is not None:
        ids = known.select(F.col(conv_col).alias("conv_id"), F.lit(KNOWN).alias("kind")).distinct()
        told = told.unionByName(ids, allowMissingColumns=True)
    return told.repartition("conv_id").sortWithinPartitions(*KEY, "kind")


def _is_cut(symbol: Column) -> Column:
    return symbol.isin([i for i, (_, cut) in enumerate(SYMBOLS) if cut])


def _lines(batches):
    """``(conversation, edit row or None, [(letter, role, text), ...])`` in reading order.  A row that is kept or
    reroled comes with the first text behind its edit; what needs no text, with the edit."""
    columns = ["conv_id", "kind", "text", "turn", "role", "copies", "blank", "seen", "cut", "before",
               "edit", "new_role", "after"]
    waiting = None
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns)):
            conv, kind, text, before, letter, role, after = *row[:3], *row[9:]
            if kind == EDIT:
                waiting = None
                lines = [("I", ROLES[i], "") for i in before]
                yield conv, row[3:9], lines + [("D", None, None)] * (letter == "D")
                if letter != "D":
                    waiting = letter, role or row[4], after
                elif after:
                    yield conv, None, [("I", ROLES[i], "") for i in after]
            elif kind == TEXT and waiting:
                letter, role, after = waiting
                waiting = None
                yield conv, None, [(letter, role, text), *(("I", ROLES[i], "") for i in after)]
            else:
                yield conv, None, []


class _Account:
    """What ``transcripts`` says of a conversation, gathered in reading order."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = self.turns = 0
        self.low = self.turn = self.initial = None
        self.audit, self.hash, self.lines, self.extra, self.cut = [], sha256(), 0, 0, False

    def read(self, turn, role, copies, blank, seen, cut) -> None:
        """A distinct row as it was."""
        self.delete_copies()
        if self.initial is not None:
            self.illegal += self.initial + role[:1] not in LEGAL
        self.illegal += copies - 1                  # no role may follow itself
        self.initial, self.cut, self.extra = role[:1], cut, copies - 1
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies - (not seen)
            self.truncated += cut
        if turn is not None:
            self.turns += turn != self.turn
            self.low = turn if self.low is None else self.low
            self.turn = turn

    def write(self, letter, role, text) -> None:
        self.audit.append(letter)
        self.cost += COST[letter] + (TRUNCATED if self.cut and letter in "KR" else 0)
        if letter != "D":
            self.hash.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
            self.lines += 1

    def delete_copies(self) -> None:
        """Further copies of a row go right behind its first one."""
        self.audit.append("D" * self.extra)
        self.cost += DELETE * self.extra
        self.extra = 0

    def row(self) -> tuple:
        self.delete_copies()
        gaps = 0 if self.low is None else self.turn - self.low + 1 - self.turns
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost,
                "".join(self.audit), self.hash.hexdigest())


NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def transcripts(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text", copies_col: str | None = None,
                known: DataFrame | None = None) -> DataFrame:
    """One row for each conversation: ``conv_id``, ``gaps`` (turn numbers between the least and the greatest
    that don't occur), the numbers of ``blank, duplicate, truncated`` rows and of ``illegal`` adjacent
    roles, ``cost``, ``audit`` (the letters of the edits in order) and ``repaired_sha256`` (of the lines
    ``role:text``).  Conversations of ``known`` without a row get zeros and empty texts."""
    told = _told(convs, conv_col, turn_col, role_col, text_col, copies_col, known)
    conv_type = _arrow(told, "conv_id")
    schema = StructType([told.schema["conv_id"]])
    for name in NUMBERS:
        schema = schema.add(name, "long")
    schema = schema.add("audit", "string").add("repaired_sha256", "string")
    types = [conv_type, *[pa.int64()] * len(NUMBERS), pa.string(), pa.string()]

    def accounts(batches):
        conv, account = None, None
        for this, row, lines in _lines(batches):
            if account is None or this != conv:
                if account is not None:
                    yield conv, *account.row()
                conv, account = this, _Account()
            if row is not None:
                account.read(*row)
            for letter, role, text in lines:
                if row is None and letter == "I":   # at the end, behind the copies of the last row
                    account.delete_copies()
                account.write(letter, role, text)
        if account is not None:
            yield conv, *account.row()

    return told.mapInArrow(lambda batches: _batches(accounts(batches), types, schema), schema)


def repaired_turns(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text",
                   copies_col: str | None = None) -> DataFrame:
    """The repaired conversations: ``conv_id, turn`` (from 0), ``role, text, edit`` (K, R or I)."""
    told = _told(convs, conv_col, turn_col, role_col, text_col, copies_col)
    schema = (StructType([told.schema["conv_id"]]).add("turn", "long").add("role", "string")
              .add("text", "string").add("edit", "string"))
    types = [_arrow(told, "conv_id"), pa.int64(), pa.string(), pa.string(), pa.string()]

    def turns(batches):
        conv, turn = None, None
        for this, _, lines in _lines(batches):
            if turn is None or this != conv:
                conv, turn = this, 0
            for letter, role, text in lines:
                if letter != "D":
                    yield conv, turn, role, text, letter
                    turn += 1

    return told.mapInArrow(lambda batches: _batches(turns(batches), types, schema), schema)


def _batches(rows, types, schema: StructType):
    while held := list(islice(rows, ROWS_AT_ONCE)):
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*held), types)], names=schema.fieldNames())
