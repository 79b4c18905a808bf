"""A bounded memory of what words map to, as numpy arrays: some 40 bytes an entry where a dict takes 200.

A word of at most `SHORT` bytes is named exactly by two 64-bit numbers: its bytes, its length and how it is preceded. A hash of
the two orders the table; a hit compares both, so no word ever gets another's entry.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

from lociframe.llm import arrays as A

U64 = A.U64
SHORT = 15
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)
_LOW, _HIGH = _MASK[np.minimum(np.arange(17), 8)], _MASK[np.maximum(np.arange(17) - 8, 0)]


def word_keys(data: np.ndarray, start: np.ndarray, end: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(names (n, 2), flag of those of at most SHORT bytes) of the spans [start, end); kind: 0 to 15, part of the name."""
    size = end - start
    short = size <= SHORT
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    names = np.lib.stride_tricks.sliding_window_view(padded, 16)[start].view(U64)
    shown = np.minimum(size, 16)
    names[:, 0] &= _LOW[shown]
    names[:, 1] &= _HIGH[shown]
    names[:, 1] |= (np.minimum(size, SHORT) + 16 * kind).astype(U64) << U64(56)
    return names, short


def name_hash(names: np.ndarray) -> np.ndarray:
    return A.mix(A.mix(names[:, 0] + A.GRAM) * A.MULT ^ names[:, 1])


def distinct(names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the distinct name of each row, first row of each distinct name, their hashes)."""
    h = name_hash(names)
    which, hashes = pd.factorize(h)
    first = np.empty(len(hashes), np.int64)
    first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
    if (names[first[which]] != names).any():  # two names of one hash: tell them apart by the names themselves
        _, first, which = np.unique(names, axis=0, return_index=True, return_inverse=True)
        which, hashes = which.ravel(), h[first]
    return which, first, hashes


def runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions start[0], start[0] + 1, ... of every run, one after the other."""
    total = np.cumsum(size)
    return np.repeat(start - (total - size), size) + np.arange(int(total[-1]) if len(total) else 0)


class WordTable:
    """Names -> runs of ids (and one row of numbers each). Beyond `bound` entries, those not asked for longest go."""

    def __init__(self, bound: int, numbers: int = 0):
        self.bound, self.clock = bound, 0
        self.hash, self.names = np.zeros(0, U64), np.zeros((0, 2), U64)
        self.start, self.size, self.used = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.uint32)
        self.numbers = np.zeros((0, numbers))

    def __len__(self) -> int:
        return len(self.hash)

    def find(self, names: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Row of each distinct name, -1 if it is not known."""
        self.clock += 1
        if not len(self.hash):
            return np.full(len(names), -1)
        order = np.argsort(hashes)
        at = np.empty(len(hashes), np.int64)
        at[order] = np.minimum(np.searchsorted(self.hash, hashes[order]), len(self.hash) - 1)
        known = (self.hash[at] == hashes) & (self.names[at] == names).all(1)
        self.used[at[known]] = self.clock
        return np.where(known, at, -1)

    def add(self, names: np.ndarray, hashes: np.ndarray, size: np.ndarray, ids: np.ndarray, numbers: np.ndarray | None = None) -> None:
        """New names with their ids one after the other. Of two names with one hash, one is remembered."""
        keep = np.arange(len(self.hash))
        if len(self.hash) + len(hashes) > self.bound:
            keep = np.sort(np.argsort(-self.used, kind="stable")[: max(0, self.bound - len(hashes))])
            self.pool = self.pool[runs(self.start[keep], self.size[keep])]
            self.start = np.cumsum(self.size[keep]) - self.size[keep]
        else:
            self.start = self.start[keep]
        h = np.concatenate([self.hash[keep], hashes])
        order = np.argsort(h, kind="stable")
        fresh = np.concatenate([[True], np.diff(h[order]) != 0]) if len(h) else np.zeros(0, bool)
        order = order[fresh]
        ends = np.cumsum(size)
        self.hash = h[order]
        self.names = np.concatenate([self.names[keep], names])[order]
        self.start = np.concatenate([self.start, len(self.pool) + ends - size])[order]
        self.size = np.concatenate([self.size[keep], size.astype(np.int32)])[order]
        self.used = np.concatenate([self.used[keep], np.full(len(hashes), self.clock, np.int32)])[order]
        self.pool = np.concatenate([self.pool, ids])
        if self.numbers.shape[1]:
            self.numbers = np.concatenate([self.numbers[keep], numbers])[order]
