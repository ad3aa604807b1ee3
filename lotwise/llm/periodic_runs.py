"""Periodic runs of the words of each text, by recompression.

A run is a stretch of consecutive words with smallest period q, of at least
``max(min_length, min_exponent * q)`` words, that can't be extended to either side keeping
period q.  ``min_exponent`` is 2 or more.

1. The texts of a block become one array of word numbers with a barrier around each text, and a
   run-length grammar over it (``recompression``).
2. The places of a run at which a word equals the one q further on are a stretch of at least
   ``max(min_length, min_exponent * q) - q`` words, so it holds a place of the grid with that
   spacing.  The grids of all periods have harmonically few places in sum, n log n.
3. Where the two words of a grid place are the same, the grammar gives the exact extension to both
   sides.  Stretches that are long enough are runs; of one stretch the smallest period counts (all
   others that it is found with are multiples of it).

Each text is a row of its own, so there is no shuffle and no group.  A block is about
``BLOCK_BYTES`` of text or one longer text.

Defined cases: words are what stands between characters of the ASCII white space; a null text and one
without words have no runs and an empty collapsed text; repeated rows are treated alike; an
empty table gives no rows; all columns of the input stay (an output column whose name the
input has already raises an error).
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, StructType

from lotwise.llm.recompression import Grammar
from lotwise.llm.shingles import text_blocks

MIN_LENGTH, MIN_EXPONENT = 24, 3
BLOCK_BYTES = 1 << 20
PLACES_AT_ONCE = 1 << 20


def _joined(texts: list[list[bytes]], min_length: int):
    """Word numbers of all texts that are long enough for a run, with barriers between them, the
    number of barriers, and where each of those texts begins."""
    long = [i for i, words in enumerate(texts) if len(words) >= min_length]
    barriers = len(long) + 1
    numbers: dict[bytes, int] = {}
    flat, starts = [0], []
    for k, i in enumerate(long):
        starts.append(len(flat))
        flat += [numbers.setdefault(w, len(numbers) + barriers) for w in texts[i]]
        flat.append(k + 1)
    return np.array(flat, np.int64), barriers, long, np.array(starts, np.int64)


def _grid(text: np.ndarray, longest: int, min_length: int, min_exponent: int):
    """Places and periods at which a run may be found: grid places whose word comes again."""
    periods = np.arange(1, longest // min_exponent + 1)
    spacing = np.maximum(min_length, min_exponent * periods) - periods
    count = np.maximum(0, -(-(len(text) - periods) // spacing))
    upto = np.cumsum(count)
    first = 0
    while first < len(periods):
        last = max(first + 1, int(np.searchsorted(
            upto, (upto[first - 1] if first else 0) + PLACES_AT_ONCE, "right")))
        n = count[first:last]
        period = np.repeat(periods[first:last], n)
        place = (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)) * np.repeat(
            spacing[first:last], n)
        again = text[place] == text[place + period]
        yield place[again], period[again]
        first = last


def runs_of(texts: list[list[bytes]], min_length: int = MIN_LENGTH,
            min_exponent: int = MIN_EXPONENT) -> list[np.ndarray]:
    """For each list of words its runs as rows ``start, length, period``, sorted."""
    out = [np.zeros((0, 3), np.int64)] * len(texts)
    text, barriers, long, starts = _joined(texts, min_length)
    if not long:
        return out
    text_of = np.cumsum(text < barriers) - 1
    longest = max(len(texts[i]) for i in long)
    places, periods = [], []
    for place, period in _grid(text, longest, min_length, min_exponent):
        own = (text_of[place] == text_of[place + period]) & (text[place] >= barriers)
        places.append(place[own])
        periods.append(period[own])
    place, period = np.concatenate(places), np.concatenate(periods)
    if not len(place):
        return out
    grammar = Grammar(text, barriers)
    right = grammar.extend(place, place + period, 1)
    left = grammar.extend(place, place + period, -1)
    start, length = place - left + 1, left + right - 1 + period
    kept = length >= np.maximum(min_length, min_exponent * period)
    found = np.stack([start[kept], length[kept], period[kept]], axis=1)
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    # The smallest period of each stretch, then in order of start and period.
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[new]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    number = np.searchsorted(starts, found[:, 0], "right") - 1
    edges = np.searchsorted(number, np.arange(len(long) + 1))
    for k, i in enumerate(long):
        mine = found[edges[k]:edges[k + 1]].copy()
        mine[:, 0] -= starts[k]
        out[i] = mine
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by blanks, without those that repeat the first period of a run."""
    if len(runs):
        depth = np.zeros(len(words) + 1, np.int64)
        np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
        np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]
    return b" ".join(words)


def _run_arrays(runs: list[np.ndarray]) -> pa.Array:
    rows = np.concatenate([np.zeros((0, 3), np.int64), *runs])
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
    entries = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(3)],
                                         names=["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(offsets), entries)


def find_runs(docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH,
              min_exponent: int = MIN_EXPONENT, collapse: bool = True) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (structs ``start, length, period``, by start and
    period) and, if ``collapse``, ``collapsed`` in place of the text column."""
    if min_exponent < 2 or min_length < 2 * min_exponent:
        raise ValueError("min_exponent has to be 2 or more, min_length twice that or more")
    rest = [c for c in docs.columns if c != text_col]
    made = ["n_words", "runs", *(["collapsed"] if collapse else [])]
    clash = {c.lower() for c in rest} & set(made)
    if clash:
        raise ValueError(f"the input has columns named {sorted(clash)} already")
    schema = StructType([docs.schema[c] for c in rest])
    entry = StructType().add("start", "long").add("length", "long").add("period", "long")
    schema = schema.add("n_words", "long").add("runs", ArrayType(entry))
    if collapse:
        schema = schema.add("collapsed", "string")

    def run(batches):
        for batch in batches:
            texts, first = batch.column(0), 0
            for block in text_blocks(((t.as_py() or "").encode() for t in texts), BLOCK_BYTES):
                split = [t.split() for t in block]      # bytes split at ASCII white space
                runs = runs_of(split, min_length, min_exponent)
                columns = [batch.column(i + 1).slice(first, len(block)) for i in range(len(rest))]
                columns += [pa.array([len(w) for w in split], pa.int64()), _run_arrays(runs)]
                if collapse:
                    columns.append(pa.array(
                        [collapsed(w, r).decode() for w, r in zip(split, runs)], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=rest + made)
                first += len(block)

    return docs.select(text_col, *rest).mapInArrow(run, schema)
