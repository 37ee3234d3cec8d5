"""Remembers what a tokenizer gave for pieces that it handles independently of their surroundings."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from .hashing import U


def _distinct(h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of one of each pair (h, g), number of each row's pair)"""
    _, first, inv = np.unique(h, return_index=True, return_inverse=True)
    if (g != g[first][inv]).any():
        _, first, inv = np.unique(np.stack([h, g], 1), axis=0, return_index=True, return_inverse=True)
    return first, inv.reshape(-1)


class Memo:
    """ids of pieces by two independent 64-bit hashes of each, in an open-addressing table of numpy arrays.

    ``bits`` bounds what a worker remembers (half of 2**bits pieces); it does not change results.
    """

    def __init__(self, encode: Callable[[list[str]], list], bits: int = 21, lengths_only: bool = False):
        self.encode, self.bits, self.lengths_only = encode, bits, lengths_only
        self.clear()

    def clear(self) -> None:
        self.key = np.zeros(1 << self.bits, np.uint64)
        self.check = np.zeros(1 << self.bits, np.uint64)
        self.value = np.full(1 << self.bits, -1, np.int32)
        self.n = np.zeros(1 << 12, np.int32)
        self.start = np.zeros(1 << 12, np.int64)
        self.pool, self.used, self.size = np.zeros(1 << 16, np.uint32), 0, 0

    def _add(self, hashes: np.ndarray, checks: np.ndarray, texts: list[str]) -> None:
        for lo in range(0, len(texts), 20_000):
            got = self.encode(texts[lo : lo + 20_000])
            n = np.fromiter(got if self.lengths_only else map(len, got), np.int32, len(got))
            k = self.size
            while k + len(n) > len(self.n):
                self.n, self.start = np.resize(self.n, 2 * len(self.n)), np.resize(self.start, 2 * len(self.start))
            self.n[k : k + len(n)] = n
            if not self.lengths_only:
                total = int(n.sum())
                while self.used + total > len(self.pool):
                    self.pool = np.resize(self.pool, 2 * len(self.pool))
                self.pool[self.used : self.used + total] = np.fromiter((i for x in got for i in x), np.uint32, total)
                self.start[k : k + len(n)] = self.used + np.cumsum(n) - n
                self.used += total
            self.size += len(n)
        mask, slot, left = U((1 << self.bits) - 1), hashes.copy(), np.arange(len(hashes))
        number = np.arange(self.size - len(hashes), self.size, dtype=np.int32)
        while len(left):
            at = (slot[left] & mask).astype(np.int64)
            free = self.value[at] < 0
            self.value[at[free]] = number[left[free]]  # of several for one slot the last stays
            won = free & (self.value[at] == number[left])
            self.key[at[won]] = hashes[left[won]]
            self.check[at[won]] = checks[left[won]]
            left = left[~won]
            slot[left] += U(1)

    def _look(self, h: np.ndarray, g: np.ndarray) -> np.ndarray:
        mask, out, left, step = U((1 << self.bits) - 1), np.full(len(h), -1, np.int64), np.arange(len(h)), U(0)
        while len(left):
            at = ((h[left] + step) & mask).astype(np.int64)
            value = self.value[at]
            hit = (self.key[at] == h[left]) & (self.check[at] == g[left]) & (value >= 0)
            out[left[hit]] = value[hit]
            left = left[(value >= 0) & ~hit]
            step += U(1)
        return out

    def find(self, data: np.ndarray, h: np.ndarray, g: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """The number under which each span [s, e) of data, with hashes h and g, is remembered, until the next call."""
        at = self._look(h, g)
        new = np.flatnonzero(at < 0)
        if len(new):
            first, inv = _distinct(h[new], g[new])
            if self.size + len(first) > 1 << (self.bits - 1):
                self.clear()
                new = np.arange(len(h))
                first, inv = _distinct(h, g)
                while len(first) > 1 << (self.bits - 1):
                    self.bits += 1
                    self.clear()
            raw = data.tobytes()
            k = self.size
            one = new[first]
            self._add(h[one], g[one], [raw[a:b].decode() for a, b in zip(s[one].tolist(), e[one].tolist())])
            at[new] = k + inv
        return at

    def stream(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in order, ids of each span) for the numbers that find() gave."""
        n = self.n[at].astype(np.int64)
        end = np.cumsum(n)
        where = np.repeat(self.start[at] - (end - n), n) + np.arange(end[-1] if len(end) else 0)
        return self.pool[where], n
