"""Encode every distinct span of text once: a cache of id sequences in flat arrays."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def gather(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The parts of ``flat`` at ``begin`` of length ``size``, one after the other."""
    total = int(size.sum())
    return flat[np.repeat(begin - np.cumsum(size) + size, size) + np.arange(total)]


class SpanCache:
    """From a 64-bit key to a sequence of ids, kept sorted by key.

    When a call could bring it beyond ``limit`` keys, or it holds more than
    ``ids`` ids, it keeps those keys that were asked for again since the last
    time (none, if these fill more than half of it); so its memory is bounded
    by these numbers and one call's keys. Answers do not depend on what it
    holds.
    """

    def __init__(self, limit: int = 1 << 18, ids: int = 1 << 22):
        self.limit, self.ids = limit, ids
        self.clear()

    def clear(self) -> None:
        self.keys, self.again = np.zeros(0, np.uint64), np.zeros(0, bool)
        self.begin, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def shrink(self) -> None:
        stay = np.flatnonzero(self.again)
        size = self.size[stay]
        if 2 * len(stay) > self.limit or 2 * size.sum() > self.ids:
            return self.clear()
        self.flat = gather(self.flat, self.begin[stay], size)
        self.keys, self.again = self.keys[stay], np.zeros(len(stay), bool)
        self.begin, self.size = np.cumsum(size) - size, size

    def sequences(self, keys: np.ndarray, encode: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]):
        """Flat ids, and the begin and size of each key's.

        ``encode`` gets positions in ``keys`` (one for each key that is not
        held) and returns their flat ids and sizes.
        """
        one, at, back = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) + len(one) > self.limit or len(self.flat) > self.ids:
            self.shrink()
        slot = np.searchsorted(self.keys, one)
        held = slot < len(self.keys)
        held[held] = self.keys[slot[held]] == one[held]
        self.again[slot[held]] = True
        if not held.all():
            flat, size = encode(at[~held])
            begin = len(self.flat) + np.cumsum(size) - size
            self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
            where = slot[~held]
            self.keys = np.insert(self.keys, where, one[~held])
            self.again = np.insert(self.again, where, False)
            self.begin = np.insert(self.begin, where, begin)
            self.size = np.insert(self.size, where, size)
            slot = np.searchsorted(self.keys, one)
        return self.flat, self.begin[slot][back], self.size[slot][back].astype(np.int64)
