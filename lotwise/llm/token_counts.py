"""Token counts by a compiled finite-state tokenizer.

Counting the tokens of a byte-level BPE vocabulary is done by two deterministic
transducers and a scan:

* ``WordTransducer`` reads segments (blanks and the word after them).  A transition on a
  segment is annotated with the number of tokens it emits.  Transitions are compiled when
  first needed, for all new segments of a block of texts together, in lockstep over their bytes
  with numpy.
* ``BpeTransducer`` reads the bytes of one pre-token and serves long ones, which lockstep
  doesn't suit.  A state holds the bytes that a token may still continue and, for each
  position within them, the last token of the encoding up to there and its count: all that
  the future depends on.  A transition on a byte is annotated with the change of the count.
* A text is cut into chunks.  The state map of a chunk is ``(head, count, tail)``: its
  tokens between the first and last sure boundary are counted, what lies outside is kept.
  Where a blank follows a non-blank a token always ends, whatever the context.  Maps
  compose associatively, so the maps of all chunks are combined by a parallel prefix scan.

Both transducers rest on a property of BPE: the encoding of a prefix ends with one
token, the one whose pair with the token before it stays unmerged when both are encoded.

Spark deals the rows to tasks; the vocabulary, a file of fixed size, is broadcast. The
transducers are compiled in the Python workers and bounded there.

Defined cases: null and empty texts have 0 tokens; a special token's string inside a text
is that one token, as the library does by default; repeated rows are counted each; an
empty table gives no rows; other columns are kept as they are, a column of the input named as
an output is replaced.
"""
from __future__ import annotations

import json
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from lotwise.llm.double_array import DoubleArrayTrie, by_length, spans
from lotwise.llm.memo import BulkMemo, Memo, blocks, per_worker

CHUNK_CHARS = 1 << 16
MAX_STATES = 100_000
LONG_BYTES = 64

# Unicode white space, and the pre-token pattern of the vocabulary.
BLANKS = "\t-\r \x85\xa0  -     　"
PRE_TOKENS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
              rf"| ?[^{BLANKS}\p{{L}}\p{{N}}]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+")


def printable_bytes() -> dict[str, int]:
    """The characters by which a byte-level vocabulary writes the 256 bytes: printable
    Latin-1 stands for itself, the others follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Merges by rank, as byte strings, and special tokens."""

    def __init__(self, merges: list[tuple[bytes, bytes]], special: list[str]):
        self.merges = merges
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        self.formed = {a + b: rank for rank, (a, b) in enumerate(merges)}
        self.tokens = {bytes([b]) for b in range(256)} | {a + b for a, b in merges}
        self.special = special

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        """Reads a ``tokenizers`` JSON file of a byte-level BPE model."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("a byte-level BPE vocabulary is needed")
        byte = printable_bytes()
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        merges = [tuple(bytes(byte[c] for c in part) for part in pair) for pair in pairs]
        return cls(merges, [t["content"] for t in spec["added_tokens"] if t["special"]])

    def spine(self, token: bytes, right: bool) -> list[tuple[bytes, float, float]]:
        """The symbols that stand at one end of ``token`` while it is merged, each with the
        ranks of the merge that forms it and of the merge that takes it up."""
        out, taken = [], float("inf")
        while True:
            formed = self.formed.get(token, -1)
            out.append((token, formed, taken))
            if formed < 0:
                return out
            token, taken = self.merges[formed][right], formed


class _State(dict):
    """byte -> (next state, emitted count).  ``open``: bytes that a token may continue;
    ``window``: (last token, count) at each position from before ``open`` to its end,
    counts relative to the last."""

    __slots__ = ("machine", "open", "window")

    def __init__(self, machine: BpeTransducer, open_: bytes, window: tuple):
        super().__init__()
        self.machine, self.open, self.window = machine, open_, window

    def __missing__(self, byte: int):
        step = self[byte] = self.machine.compile(self, byte)
        return step


class BpeTransducer:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.prefixes = {t[:n] for t in vocabulary.tokens for n in range(1, len(t))}
        self.right_end = Memo(lambda token: vocabulary.spine(token, True))
        self.left_end = Memo(lambda token: vocabulary.spine(token, False))
        self.stays_apart = Memo(self.pair_stays_apart)
        self.reset()

    def reset(self) -> None:
        self.states: dict[tuple, _State] = {}
        self.start = self._state(b"", ((None, 0),))

    def _state(self, open_: bytes, window: tuple) -> _State:
        state = self.states.get((open_, window))
        if state is None:
            state = self.states[open_, window] = _State(self, open_, window)
        return state

    def pair_stays_apart(self, pair: tuple[bytes, bytes]) -> bool:
        """No merge crosses the border of two tokens: each merge of a symbol at the end of
        the left one with a symbol at the start of the right one comes too early or too
        late.  Of equal ranks the leftmost merge is first."""
        rank_of = self.vocabulary.ranks.get
        right = self.left_end[pair[1]]
        for x, x_formed, x_taken in self.right_end[pair[0]]:
            for y, y_formed, y_taken in right:
                rank = rank_of((x, y))
                if (rank is not None and x_formed < rank and y_formed < rank
                        and rank < x_taken and rank <= y_taken):
                    return False
        return True

    def compile(self, state: _State, byte: int) -> tuple[_State, int]:
        read = state.open + bytes([byte])
        for start in range(len(read)):
            token = read[start:]
            if token in self.vocabulary.tokens:
                before, count = state.window[start]
                if before is None or self.stays_apart[before, token]:
                    break
        count += 1
        keep = next((i for i in range(len(read)) if read[i:] in self.prefixes), len(read))
        window = (*state.window, (token, count))[keep:]
        return self._state(read[keep:], tuple((t, n - count) for t, n in window)), count

    def count(self, text: bytes) -> int:
        state, total = self.start, 0
        for byte in text:
            state, emitted = state[byte]
            total += emitted
        if len(self.states) > MAX_STATES:
            self.reset()
        return total


class PreTokenCounter:
    """Token counts of many distinct pre-tokens at once."""

    def __init__(self, vocabulary: Vocabulary):
        self.bpe = BpeTransducer(vocabulary)
        self.tokens = sorted(vocabulary.tokens)
        self.trie = DoubleArrayTrie({t: i for i, t in enumerate(self.tokens)})
        self.stays_apart = Memo(self._stays_apart, limit=400_000)

    def _stays_apart(self, pair: int) -> bool:
        left, right = divmod(pair, len(self.tokens))
        return self.bpe.pair_stays_apart((self.tokens[left], self.tokens[right]))

    def counts(self, pre_tokens: list[str]) -> list[int]:
        words = [p.encode() for p in pre_tokens]
        out = np.zeros(len(words), np.int64)
        short = [i for i, w in enumerate(words) if len(w) <= LONG_BYTES]
        for i in set(range(len(words))).difference(short) if len(short) < len(words) else ():
            out[i] = self.bpe.count(words[i])
        for chosen, matrix, lengths in by_length([words[i] for i in short]):
            last = np.full((len(chosen), matrix.shape[1] + 1), -1, np.int64)
            count = np.zeros_like(last)
            for rows, start, end, token in spans(self.trie, matrix, lengths):
                if start:
                    pairs, back = np.unique(last[rows, start] * len(self.tokens) + token,
                                            return_inverse=True)
                    apart = np.fromiter(map(self.stays_apart.__getitem__, pairs.tolist()),
                                        bool, len(pairs))[back]
                    rows, token = rows[apart], token[apart]
                last[rows, end] = token
                count[rows, end] = count[rows, start] + 1
            out[np.array(short)[chosen]] = count[np.arange(len(chosen)), lengths]
        return out.tolist()


class WordTransducer:
    """Counts, chunk state maps and their composition for one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        import re

        import regex

        self.special = (re.compile("|".join(map(re.escape, vocabulary.special)))
                        if vocabulary.special else None)
        self.segments = re.compile(f"[{BLANKS}]*[^{BLANKS}]+|[{BLANKS}]+").findall
        self.pre_tokens = regex.compile(PRE_TOKENS).findall
        self.starts_blank = re.compile(f"[{BLANKS}]").match
        self.ends_blank = re.compile(f"[{BLANKS}]\\Z").search
        self.counter = PreTokenCounter(vocabulary)
        self.pre_token = BulkMemo(self.counter.counts)
        self.emitted = BulkMemo(self._compile, limit=300_000)

    def _compile(self, segments: list[str]) -> list[int]:
        """The annotations of the transitions on new segments.  Those that begin with a
        blank and end without one are split into pre-tokens as one string, as no pre-token
        crosses from one to the next."""
        ends = [0] * len(segments)
        single = []
        for i, segment in enumerate(segments):
            if not self.starts_blank(segment) or self.ends_blank(segment):
                ends[i] = -1
                single.append(segment)
        joined = [s for s, e in zip(segments, ends) if e == 0]
        tokens = self.pre_tokens("".join(joined))
        alone = [self.pre_tokens(s) for s in single]
        self.pre_token.learn(set(chain(tokens, *alone)))
        count = self.pre_token.__getitem__
        token_ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)))
        through = np.cumsum(np.fromiter(map(count, tokens), np.int64, len(tokens)))
        segment_ends = np.cumsum(np.fromiter(map(len, joined), np.int64, len(joined)))
        at = through[np.searchsorted(token_ends, segment_ends)] if joined else through
        together = iter(np.diff(at, prepend=0).tolist())
        apart = iter([sum(map(count, t)) for t in alone])
        return [next(apart) if e else next(together) for e in ends]

    def chunk_map(self, chunk: str) -> tuple[str, int, str | None]:
        """A tail of None: no sure boundary inside, the head is the whole chunk."""
        segments = self.segments(chunk)
        if len(segments) < 2:
            return chunk, 0, None
        return segments[0], self._sum(segments[1:-1]), segments[-1]

    def compose(self, a: tuple, b: tuple) -> tuple:
        """The map of two chunks in a row."""
        (head, n, tail), (head2, n2, tail2) = a, b
        if tail is None and tail2 is None:
            return self._seam(head, head2)
        if tail is None:
            first, more, last = self._seam(head, head2)
            return (first, n2, tail2) if last is None else \
                (first, more + n2 + self._text(last), tail2)
        if tail2 is None:
            first, more, last = self._seam(tail, head2)
            return (head, n, first) if last is None else \
                (head, n + self._text(first) + more, last)
        return head, n + self._text(tail + head2) + n2, tail2

    def _seam(self, left: str, right: str) -> tuple[str, int, str | None]:
        """Two pieces without an inner boundary may have one where they meet."""
        return self.chunk_map(left + right)

    def _text(self, text: str) -> int:
        return self._sum(self.segments(text))

    def _sum(self, segments: list[str]) -> int:
        self.emitted.learn(set(segments))
        return sum(map(self.emitted.__getitem__, segments))

    def scan(self, maps: list[tuple]) -> list[tuple]:
        """Inclusive prefix scan by doubling; the steps of a round are independent."""
        step = 1
        while step < len(maps):
            maps = maps[:step] + [self.compose(maps[i - step], maps[i])
                                  for i in range(step, len(maps))]
            step *= 2
        return maps

    def fold(self, maps: list[tuple]) -> tuple:
        """The last element of ``scan`` alone, by a balanced tree."""
        while len(maps) > 1:
            maps = [reduce(self.compose, maps[i:i + 2]) for i in range(0, len(maps), 2)]
        return maps[0]

    def count(self, text: str, chunk_chars: int = CHUNK_CHARS) -> int:
        return self.counts([text], chunk_chars)[0]

    def counts(self, texts: list[str], chunk_chars: int = CHUNK_CHARS) -> list[int]:
        """Counts of a block of texts, whose new segments are compiled together."""
        totals, pieces = [0] * len(texts), []
        for i, text in enumerate(texts):
            parts = [text]
            if self.special and self.special.search(text):
                parts = self.special.split(text)
                totals[i] = len(parts) - 1
            for part in filter(None, parts):
                if len(part) <= chunk_chars:
                    pieces.append((i, self.segments(part)))
                else:
                    head, n, tail = self.fold([self.chunk_map(part[j:j + chunk_chars])
                                               for j in range(0, len(part), chunk_chars)])
                    totals[i] += n
                    pieces += [(i, self.segments(x)) for x in (head, tail) if x]
        self.emitted.learn(set(chain.from_iterable(p for _, p in pieces)))
        emitted = self.emitted.__getitem__
        for i, segments in pieces:
            totals[i] += sum(map(emitted, segments))
        return totals


def _machine(vocabulary: tuple) -> WordTransducer:
    return WordTransducer(Vocabulary(*vocabulary))


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text",
                 limit: int = 1024, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``docs`` without its text but with ``n_bytes, n_tokens, over_limit``."""
    shared = docs.sparkSession.sparkContext.broadcast(
        (vocabulary.merges, vocabulary.special))
    outputs = ("n_bytes", "n_tokens", "over_limit")
    rest = [c for c in docs.columns if c.lower() not in (*outputs, text_col.lower())]
    slim = docs.select(*[docs[f"`{c}`"] for c in rest],
                       F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long")
                       .alias("n_bytes"), F.col(text_col).alias("n_tokens"))
    schema = slim.schema
    schema["n_tokens"].dataType = LongType()
    at = len(rest) + 1

    def count(batches):
        machine = per_worker(_machine, shared.value)
        for batch in batches:
            texts = (text.as_py() or "" for text in batch.column(at))
            counts = [n for block in blocks(texts) for n in machine.counts(block, chunk_chars)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], pa.array(counts, pa.int64())], names=batch.schema.names)
        machine.emitted.clear()  # the worker may serve other stages next
        machine.pre_token.clear()

    return (slim.mapInArrow(count, schema)
            .withColumn("over_limit", F.col("n_tokens") > limit))
