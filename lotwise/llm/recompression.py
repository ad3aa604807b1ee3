"""Run-length grammars by recompression, and longest common extensions on them.

A grammar is built level by level over an array of symbols.  Block compression puts one symbol in
place of each maximal stretch of one symbol; pair compression splits the alphabet in two
halves and puts one symbol in place of each pair (left half, right half).  Whether neighbours are
compressed depends on the two alone, so equal stretches of the text have equal parses but for
a few symbols at their ends, and an extension is compared in large steps: up the levels
while both sides agree, down again to where they differ.  Equal symbols of a level stand for equal
text by construction; nothing rests on a hash.

All texts of a task's block share one grammar.  Barriers (symbols below ``first_free``, each
of them used once) are never compressed, so a text's parse doesn't depend on its neighbours.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from lotwise.llm.shingles import mix

#: A grammar needs no further level when its texts have at most so many symbols.
TOP_SYMBOLS = 4


@dataclass
class Level:
    """One level of symbols and how the level above groups them."""

    symbol: np.ndarray
    length: np.ndarray      # of each symbol, in symbols of the text
    parent: np.ndarray      # its place in the level above
    before: np.ndarray      # earlier symbols of the same parent
    after: np.ndarray       # later symbols of the same parent
    blocks: bool            # stretches of one symbol, or pairs


def _grouped(symbol, length, head, name, blocks):
    """The level whose groups begin where ``head`` holds, and the symbols above it."""
    start = np.flatnonzero(head)
    size = np.diff(start, append=len(symbol))
    parent = np.cumsum(head) - 1
    before = np.arange(len(symbol)) - start[parent]
    level = Level(symbol, length, parent, before, size[parent] - 1 - before, blocks)
    return level, name(start, size), np.add.reduceat(length, start)


def _named(keys: np.ndarray, change: np.ndarray, symbol: np.ndarray, free: int):
    """``symbol`` with new names, from ``free`` on, where ``change`` holds: equal keys, equal names."""
    values, number = np.unique(keys, return_inverse=True)
    out = symbol.copy()
    out[change] = number + free
    return out, free + len(values)


def _block_level(symbol, length, first_free, free):
    same = symbol[1:] == symbol[:-1]
    if not same.any():
        return None
    head = np.concatenate([[True], ~same])
    state = {}

    def name(start, size):
        change = size > 1
        keys = symbol[start][change] * np.int64(len(symbol) + 1) + size[change]
        out, state["free"] = _named(keys, change, symbol[start], free)
        return out

    level, above, lengths = _grouped(symbol, length, head, name, True)
    return level, above, lengths, state["free"]


def _pair_level(symbol, length, first_free, free, turn):
    side = (mix(symbol.astype(np.uint64) + np.uint64((turn + 1) << 40)) >> np.uint64(17)) & np.uint64(1)
    plain = symbol >= first_free
    second = np.zeros(len(symbol), bool)
    second[1:] = (side[:-1] == 0) & (side[1:] == 1) & plain[:-1] & plain[1:]
    if not second.any():
        return None
    state = {}

    def name(start, size):
        change = size == 2
        left = start[change]
        keys = symbol[left] * np.int64(free) + symbol[left + 1]
        out, state["free"] = _named(keys, change, symbol[start], free)
        return out

    level, above, lengths = _grouped(symbol, length, ~second, name, False)
    return level, above, lengths, state["free"]


class Grammar:
    """The levels over ``text``, symbols numbered from 0; those below ``first_free`` are barriers.
    The last symbol has to be one, so that no extension runs off the end."""

    def __init__(self, text: np.ndarray, first_free: int):
        symbol, length = text.astype(np.int64), np.ones(len(text), np.int64)
        free, turn, idle = int(symbol.max(initial=0)) + 1, 0, 0
        self.levels: list[Level] = []
        while self._longest(symbol, first_free) > TOP_SYMBOLS and idle < 64:
            made = _block_level(symbol, length, first_free, free)
            if made:
                self.levels.append(made[0])
                symbol, length, free = made[1:]
            made = _pair_level(symbol, length, first_free, free, turn)
            if made:
                self.levels.append(made[0])
                symbol, length, free = made[1:]
            turn, idle = turn + 1, 0 if made else idle + 1
        self.top, self.top_length = symbol, length
        self.firsts = [np.flatnonzero(level.before == 0) for level in self.levels]

    @staticmethod
    def _longest(symbol: np.ndarray, first_free: int) -> int:
        barriers = np.flatnonzero(symbol < first_free)
        return int(np.diff(barriers, prepend=-1).max(initial=1)) - 1

    def extend(self, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        """How many symbols from ``a`` and from ``b`` on are the same, place by place, to the
        right (``step`` 1) or to the left (``step`` -1), the places themselves included."""
        total = np.zeros(len(a), np.int64)
        turned: list[tuple] = []                    # by level: queries that found a difference
        live, a, b = np.arange(len(a)), a.copy(), b.copy()
        for level in self.levels:
            behind, ahead = ((level.before, level.after) if step > 0
                             else (level.after, level.before))
            differ = level.symbol[a] != level.symbol[b]
            inside = (behind[a] > 0) | (behind[b] > 0)
            rest_a, rest_b = ahead[a] + 1, ahead[b] + 1
            # A parent that both sides enter at its edge is compared a level higher.
            go = np.where(inside & ~differ, np.minimum(rest_a, rest_b), 0)
            if not level.blocks:
                go = np.minimum(go, 1)
            np.add.at(total, live, go * level.length[a])
            a, b = a + step * go, b + step * go
            stop = inside & (differ | (rest_a != rest_b))
            turned.append((live[stop], a[stop], b[stop]))
            on = ~stop
            live, a, b = live[on], level.parent[a[on]], level.parent[b[on]]
        at_top = live, a, b
        found = [np.zeros(0, np.int64)] * 3
        live, a, b = at_top
        while len(live):                            # texts have few symbols there
            differ = self.top[a] != self.top[b]
            found = [np.concatenate([x, y[differ]]) for x, y in zip(found, (live, a, b))]
            live, a, b = live[~differ], a[~differ], b[~differ]
            np.add.at(total, live, self.top_length[a])
            a, b = a + step, b + step
        live, a, b = found
        for level, first, (more, more_a, more_b) in zip(self.levels[::-1], self.firsts[::-1],
                                                        turned[::-1]):
            # Down into the children nearest to the side that we come from.
            size_a, size_b = (level.after[first[x]] + 1 for x in (a, b))
            a, b = ((first[a], first[b]) if step > 0
                    else (first[a] + size_a - 1, first[b] + size_b - 1))
            go = np.where(level.symbol[a] == level.symbol[b], np.minimum(size_a, size_b), 0)
            if not level.blocks:
                go = np.minimum(go, 1)
            np.add.at(total, live, go * level.length[a])
            a, b = a + step * go, b + step * go
            live, a, b = (np.concatenate(x) for x in ((live, more), (a, more_a), (b, more_b)))
        return total
