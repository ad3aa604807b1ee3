"""A double-array trie over byte strings."""
from __future__ import annotations

import numpy as np


class DoubleArrayTrie:
    """``base``, ``check`` and ``value`` arrays: node ``n`` moves on byte ``b`` to
    ``base[n] + b`` if ``check`` of that cell is ``n``; ``value`` is the key's value or -1.
    Node 0 is the root."""

    def __init__(self, keys: dict[bytes, int]):
        self._base, self._check, self._value = [0], [-2], [-1]
        self._free, self._next = 257, 1  # no label reaches a free cell from a base below 1
        ordered = sorted(keys)
        level = [(0, 0, len(ordered), 0)]  # node, range of keys, depth
        while level:
            below = []
            for node, first, last, depth in level:
                if first < last and len(ordered[first]) == depth:
                    self._value[node] = keys[ordered[first]]
                    first += 1
                starts = [i for i in range(first, last)
                          if i == first or ordered[i][depth] != ordered[i - 1][depth]]
                if not starts:
                    continue
                labels = [ordered[i][depth] for i in starts]
                base = self._place(labels)
                self._base[node] = base
                for label, i, end in zip(labels, starts, [*starts[1:], last]):
                    self._check[base + label] = node
                    below.append((base + label, i, end, depth + 1))
            level = below
        self.base = np.array(self._base, np.int32)
        self.check = np.array(self._check, np.int32)
        self.value = np.array(self._value, np.int32)

    def _place(self, labels: list[int]) -> int:
        """A base at which the cells of all labels are free: the first one for a single
        label, the next one after the last found for several, so that building stays
        linear and single labels fill the holes."""
        check, size = self._check, len(self._check)
        if len(labels) == 1:
            while self._free < size and check[self._free] != -1:
                self._free += 1
            base = self._free - labels[0]
        else:
            base = self._next
        while any(base + x < size and check[base + x] != -1 for x in labels):
            base += 1
        if len(labels) > 1:
            self._next = base
        more = base + 256 - len(check)
        if more > 0:
            self._base += [0] * more
            check += [-1] * more
            self._value += [-1] * more
        return base

    def arrays(self) -> tuple[list[int], list[int], list[int]]:
        """As lists, which are faster to index one at a time."""
        return self.base.tolist(), self.check.tolist(), self.value.tolist()


def spans(trie: DoubleArrayTrie, matrix: np.ndarray, lengths: np.ndarray):
    """All keys inside many words at once.

    Word ``i`` is ``matrix[i, :lengths[i]]``.  Yields ``(rows, start, end, values)`` in order
    of start, then end: the words ``rows`` hold keys with ``values`` from start to end.
    """
    width = matrix.shape[1]
    cells = len(trie.check)
    for start in range(width):
        rows = np.flatnonzero(lengths > start)
        node = np.zeros(len(rows), np.int32)
        for end in range(start, width):
            cell = trie.base[node] + matrix[rows, end]
            cell[cell >= cells] = 0
            goes_on = (trie.check[cell] == node) & (lengths[rows] > end)
            rows, node = rows[goes_on], cell[goes_on]
            if not len(rows):
                break
            value = trie.value[node]
            found = value >= 0
            if found.any():
                yield rows[found], start, end + 1, value[found]


def by_length(words: list[bytes]):
    """Cuts words into matrices of similar length: ``(indices, matrix, lengths)``."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    edges = np.searchsorted(lengths[order], [0, 9, 13, 17, 25, 41, 1 << 62])
    for first, last in zip(edges, edges[1:]):
        if first < last:
            chosen = order[first:last]
            width = int(lengths[chosen[-1]])
            flat = b"".join([words[i].ljust(width, b"\0") for i in chosen.tolist()])
            yield (chosen, np.frombuffer(flat, np.uint8).reshape(-1, width).astype(np.int32),
                   lengths[chosen])
