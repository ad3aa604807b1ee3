"""SentencePiece encoding (unigram Viterbi) and decoding.

Pieces with log scores are kept in a double-array trie.  A text is normalised as the
model file says (a leading marker, blanks written as the marker U+2581), and the
segmentation with the largest sum of scores is found by dynamic programming.  A character
without a piece costs 10 more than the worst piece and is written as byte pieces.
Decoding joins the pieces, reads runs of byte pieces as UTF-8 and turns markers
into blanks.

No piece has a marker after another character (checked when a model is loaded), so the
best segmentation of a text is that of its words (marker run and following characters)
one by one.  The words that a task hasn't met yet are segmented together, in lockstep
over the trie with numpy, and memoised up to a fixed number.

A public vocabulary of merges has ranks and no probabilities.  For such a file the
log score of a piece is Zipf's, ``-log(rank + 2.7)``; a unigram file's scores are used
as they are.

The pieces (a file of fixed size) are read on the driver and broadcast; rows are encoded
where they are, without a shuffle.

Defined cases: null and empty texts have no pieces and decode to an empty text; a literal U+2581 in a text
decodes to a blank, as the library does; a word of any length is encoded whole; repeated rows
are encoded each; an empty table gives no rows; other columns are kept, one named as an
output is replaced.
"""
from __future__ import annotations

import math
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from lotwise.llm.double_array import DoubleArrayTrie, by_length, spans
from lotwise.llm.memo import BulkMemo, blocks, per_worker

MARKER = "▁"
UNKNOWN_PENALTY = 10.0
ZIPF_SHIFT = 2.7
LONG_CHARS = 64
#: What a worker holds at a time: characters to encode, ids to decode (or one longer text).
BLOCK_CHARS, BLOCK_IDS = 1 << 19, 1 << 18


class Pieces:
    """What a model file holds: pieces, log scores, byte pieces."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]):
        self.pieces, self.scores, self.kinds = pieces, scores, kinds
        if any(MARKER in p.lstrip(MARKER) for p, k in zip(pieces, kinds) if k == "normal"):
            raise ValueError("a piece holds a marker after another character")
        if kinds.count("byte") != 256:
            raise ValueError("byte fallback needs the 256 byte pieces")

    @classmethod
    def from_file(cls, path: str) -> Pieces:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        kinds = ["byte" if model.is_byte(i) else "other" if model.is_control(i)
                 or model.is_unknown(i) or model.is_unused(i) else "normal" for i in ids]
        scores = [model.get_score(i) for i in ids]
        normal = [s for s, k in zip(scores, kinds) if k == "normal"]
        if all(s == int(s) for s in normal):  # merge ranks
            scores = [-math.log(min(-s, len(scores)) + ZIPF_SHIFT) if k == "normal" else 0.0
                      for s, k in zip(scores, kinds)]
        return cls([model.id_to_piece(i) for i in ids], scores, kinds)


class PieceDecoder:
    """Joins pieces to texts."""

    def __init__(self, pieces: Pieces):
        def surface(piece: str, kind: str) -> bytes:
            if kind == "byte":
                return bytes([int(piece[3:5], 16)])
            return piece.replace(MARKER, " ").encode() if kind == "normal" else b""

        self.surface = list(map(surface, pieces.pieces, pieces.kinds))

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


class UnigramCodec(PieceDecoder):
    def __init__(self, pieces: Pieces):
        super().__init__(pieces)
        normal = [i for i, k in enumerate(pieces.kinds) if k == "normal"]
        self.scores = pieces.scores
        self.unknown = min(pieces.scores[i] for i in normal) - UNKNOWN_PENALTY
        self.trie = DoubleArrayTrie({pieces.pieces[i].encode(): i for i in normal})
        self.base, self.check, self.value = self.trie.arrays()
        self.score_of = np.array(pieces.scores)
        single = {pieces.pieces[i] for i in normal if len(pieces.pieces[i]) == 1}
        inside = set().union(*(pieces.pieces[i] for i in normal)) - {MARKER}
        known = re.escape("".join(sorted(inside)))
        # A word is markers and characters that some piece holds; others stand alone.
        self.words = re.compile(f"{MARKER}*[{known}]+|{MARKER}+|[^{known}]").findall
        self.has_unknown = re.compile(f"[^{re.escape(''.join(sorted(single)))}]").search
        of_byte = {int(pieces.pieces[i][3:5], 16): i
                   for i, k in enumerate(pieces.kinds) if k == "byte"}
        self.byte_ids = [of_byte[b] for b in range(256)]
        self.packed = BulkMemo(self._pack, limit=300_000)

    def segment(self, word: str) -> list[int]:
        """Viterbi over the characters of one word, of any length and content."""
        text = word.encode()
        n, base, check, value, scores = len(text), self.base, self.check, self.value, self.scores
        best = [0.0] + [-math.inf] * n
        back: list[tuple[int, int]] = [(0, 0)] * (n + 1)  # start and id, -1 for unknown
        cells, start = len(check), 0
        while start < n:
            lead = text[start]
            char_end = start + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
            here, node, known = best[start], 0, False
            for end in range(start, n):
                cell = base[node] + text[end]
                if cell >= cells or check[cell] != node:
                    break
                node = cell
                piece = value[node]
                if piece >= 0:
                    score = here + scores[piece]
                    if score > best[end + 1]:
                        best[end + 1], back[end + 1] = score, (start, piece)
                    known = known or end + 1 == char_end
            if not known and here + self.unknown > best[char_end]:
                best[char_end], back[char_end] = here + self.unknown, (start, -1)
            start = char_end
        ids, end = [], n
        while end:
            start, piece = back[end]
            ids += [piece] if piece >= 0 else [self.byte_ids[b] for b in text[start:end][::-1]]
            end = start
        return ids[::-1]

    def segment_all(self, words: list[bytes]) -> list[bytes]:
        """``segment`` for many words whose characters all have pieces, in lockstep; ids are
        packed as 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        for chosen, matrix, lengths in by_length(words):
            every = np.arange(len(chosen))
            best = np.full((len(chosen), matrix.shape[1] + 1), -np.inf)
            best[:, 0] = 0
            back = np.zeros(best.shape, np.int32)
            piece_at = np.zeros(best.shape, np.int32)
            for rows, start, end, piece in spans(self.trie, matrix, lengths):
                score = best[rows, start] + self.score_of[piece]
                better = score > best[rows, end]
                rows = rows[better]
                best[rows, end] = score[better]
                back[rows, end], piece_at[rows, end] = start, piece[better]
            at, columns, sizes = lengths.copy(), [], np.zeros(len(chosen), np.int64)
            while (open_ := at > 0).any():
                columns.append(piece_at[every, at])
                sizes += open_
                at = np.where(open_, back[every, at], 0)
            reverse = np.stack(columns, axis=1)
            take = sizes[:, None] - 1 - np.arange(reverse.shape[1])
            ids = np.take_along_axis(reverse, np.maximum(take, 0), axis=1).astype(np.int32)
            row_bytes = ids.tobytes()
            width = 4 * ids.shape[1]
            for j, (i, n) in enumerate(zip(chosen.tolist(), sizes.tolist())):
                out[i] = row_bytes[j * width:j * width + 4 * n]
        return out

    def _pack(self, words: list[str]) -> list[bytes]:
        odd = {i for i, w in enumerate(words) if len(w) > LONG_CHARS or self.has_unknown(w)}
        plain = iter(self.segment_all([w.encode() for i, w in enumerate(words) if i not in odd]))
        return [np.array(self.segment(w), np.int32).tobytes() if i in odd else next(plain)
                for i, w in enumerate(words)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text of a block, packed as 32-bit integers."""
        words = [self.words(MARKER + t.replace(" ", MARKER)) if t else [] for t in texts]
        self.packed.learn(set(chain.from_iterable(words)))
        return [b"".join(map(self.packed.__getitem__, w)) for w in words]


def _without(docs: DataFrame, *names: str) -> DataFrame:
    gone = {n.lower() for n in names}
    return docs.select(*[docs[f"`{c}`"] for c in docs.columns if c.lower() not in gone])


def encode(docs: DataFrame, pieces: Pieces, text_col: str = "text", ids_col: str = "piece_ids",
           decoded_col: str | None = None) -> DataFrame:
    """``docs`` with the array of piece ids of each text under ``ids_col`` and, if ``decoded_col`` is given,
    what the ids decode to, in the same pass.  A worker holds the ids of one block at a time."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    docs = _without(docs, ids_col, *([decoded_col] if decoded_col else []))
    schema = StructType([*docs.schema.fields, StructField(ids_col, ArrayType(IntegerType()))])
    if decoded_col:
        schema = schema.add(decoded_col, "string")
    at = [c.lower() for c in docs.columns].index(text_col.lower())

    def run(batches):
        codec = per_worker(UnigramCodec, shared.value)
        for batch in batches:
            first = 0
            for block in blocks((t.as_py() or "" for t in batch.column(at)), BLOCK_CHARS):
                packed = codec.encode(block)
                ends = np.cumsum([0] + [len(p) // 4 for p in packed], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(
                    np.frombuffer(b"".join(packed), np.int32)))
                columns = [*batch.slice(first, len(block)).columns, ids]
                first += len(block)
                if decoded_col:
                    columns.append(pa.array((codec.decode(np.frombuffer(p, np.int32).tolist())
                                             for p in packed), pa.string()))
                del packed
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())
        codec.packed.clear()  # the worker may serve other stages next

    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, pieces: Pieces, ids_col: str = "piece_ids",
           out_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of ``ids_col`` under ``out_col``; null ids give an empty text."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    docs = _without(docs, out_col)
    schema = StructType([*docs.schema.fields]).add(out_col, "string")
    at = [c.lower() for c in docs.columns].index(ids_col.lower())

    def run(batches):
        decoder = per_worker(PieceDecoder, shared.value)
        for batch in batches:
            column = batch.column(at)
            flat, ends = column.values.fill_null(0).to_numpy(), column.offsets.to_numpy()
            there = column.is_valid().to_numpy(zero_copy_only=False)
            first = 0
            while first < len(batch):
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + BLOCK_IDS, "right")) - 1)
                texts = [decoder.decode(flat[a:b].tolist()) if known else "" for a, b, known in
                         zip(ends[first:last], ends[first + 1:last + 1], there[first:last])]
                columns = [*batch.slice(first, last - first).columns, pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())
                first = last

    return docs.mapInArrow(run, schema)
