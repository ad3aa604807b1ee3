"""A bounded memo for pure functions that tasks call on repeated keys."""
from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

BLOCK_CHARS = 2_000_000


_held: dict[Callable, tuple] = {}


def per_worker(make: Callable, value):
    """``make(value)``, made once in a Python worker and kept for its later tasks, so that
    what a machine has compiled or memoised is neither built nor left behind by each task.  Another
    value (of a newer broadcast) takes its place."""
    made = _held.get(make)
    if made is None or made[0] is not value:
        _held[make] = made = (value, make(value))
    return made[1]


class Memo(dict):
    """``memo[key]`` computes ``function(key)`` once for keys in use.

    Two generations of at most ``limit`` keys each: when the young one is full it
    becomes the old one, and keys that are still in use are taken over again, so memory
    is bounded.
    """

    def __init__(self, function: Callable, limit: int = 200_000):
        super().__init__()
        self.function, self.limit, self.old = function, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.function(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class BulkMemo(dict):
    """A memo whose values are computed for many keys at once: ``learn(keys)`` first,
    ``memo[key]`` then.  Keys beyond ``limit`` push out all that the last call of ``learn``
    didn't name."""

    def __init__(self, function: Callable[[list], list], limit: int = 200_000):
        super().__init__()
        self.function, self.limit = function, limit

    def learn(self, keys: set) -> None:
        new = [key for key in keys if key not in self]
        if len(self) + len(new) > self.limit:
            kept = {key: self[key] for key in keys if key in self}
            self.clear()
            self.update(kept)
        if new:
            self.update(zip(new, self.function(new)))


def blocks(texts: Iterable[str], chars: int = BLOCK_CHARS) -> Iterator[list[str]]:
    """Lists of consecutive texts of about so many characters together."""
    block, size = [], 0
    for text in texts:
        block.append(text)
        size += len(text)
        if size >= chars:
            yield block
            block, size = [], 0
    if block:
        yield block
