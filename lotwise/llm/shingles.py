"""Words and word shingles as 64-bit hashes, for many texts at once with numpy."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SEGMENT_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def byte_class(inside) -> np.ndarray:
    """A table of the bytes (A-Z lower-cased before) that are part of words.  Bytes of
    0x80 and more belong to one character each, so a class of ASCII characters and all
    others can be told byte by byte in UTF-8."""
    return np.array([bool(inside(int(_LOWER[b]))) for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _segments(flat: np.ndarray, word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts that no word crosses."""
    start, n = 0, len(flat)
    while start < n:
        end = min(n, start + SEGMENT_BYTES)
        while end < n and word[flat[end]]:
            gap = np.flatnonzero(~word[flat[end:end + SEGMENT_BYTES]])
            end = end + int(gap[0]) if len(gap) else min(n, end + SEGMENT_BYTES)
        yield start, end
        start = end


def _word_hashes(flat: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start positions of the words of one segment."""
    is_word = word[flat]
    edge = np.diff(is_word.view(np.int8), prepend=np.int8(0))
    starts = np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    body = np.flatnonzero(is_word)
    first = np.flatnonzero(edge[body] == 1)
    lengths = np.diff(first, append=len(body))
    offset = np.arange(len(body)) - np.repeat(first, lengths)
    power = np.full(int(lengths.max()), _BASE)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    value = (_LOWER[flat[body]].astype(np.uint64) + np.uint64(1)) * power[offset]
    return mix(np.add.reduceat(value, first)), starts


def words(texts: list[bytes], word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and where each text's words begin and end:
    those of text ``i`` are ``hashes[bounds[i]:bounds[i + 1]]``."""
    flat = np.frombuffer(b" ".join(texts), np.uint8)
    hashes, positions = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for start, end in _segments(flat, word):
        found, at = _word_hashes(flat[start:end], word)
        hashes.append(found)
        positions.append(at + start)
    text_ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    bounds = np.searchsorted(np.concatenate(positions), text_ends)
    return np.concatenate(hashes), np.concatenate([[0], bounds])


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each position; ``len(hashes) - k + 1`` of them."""
    n = max(0, len(hashes) - k + 1)
    total = np.full(n, k, np.uint64)
    for i in range(k):
        total = total * _BASE + hashes[i:i + n]
    return mix(total)


def text_blocks(texts, size: int = SEGMENT_BYTES) -> Iterator[list[bytes]]:
    """Lists of consecutive texts of about ``size`` bytes together."""
    block, held = [], 0
    for text in texts:
        block.append(text)
        held += len(text)
        if held >= size:
            yield block
            block, held = [], 0
    if block:
        yield block
