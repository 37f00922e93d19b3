"""Range queries over an ordered series: k-th smallest and first small value.

NumPy helpers for use inside a task, for many ranges at once: building costs
O(rows log rows) and a query O(log rows), whatever the length of its range.
"""

from __future__ import annotations

import numpy as np


class RangeRanks:
    """Wavelet matrix over the ranks of the values: per bit of a rank, from the
    highest on, how many of the first i rows have it unset; rows then go on in
    the order of that bit."""

    def __init__(self, values: np.ndarray):
        self.sorted, rank = np.unique(values, return_inverse=True)
        self.bits = max(int(len(self.sorted) - 1).bit_length(), 0) if len(values) else 0
        self.unset = []
        for bit in range(self.bits - 1, -1, -1):
            zero = (rank >> bit & 1) == 0
            self.unset.append(np.concatenate([[0], np.cumsum(zero, dtype=np.int64)]))
            rank = np.concatenate([rank[zero], rank[~zero]])

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Value number k (from 0) of ``values[lo:hi]`` in ascending order, for
        every range; k must lie in the range."""
        lo, hi, k = (np.array(x, dtype=np.int64) for x in (lo, hi, k))
        rank = np.zeros(len(lo), dtype=np.int64)
        for unset in self.unset:
            lo0, hi0 = unset[lo], unset[hi]
            one = k >= hi0 - lo0
            k = np.where(one, k - (hi0 - lo0), k)
            lo, hi = np.where(one, unset[-1] + lo - lo0, lo0), np.where(one, unset[-1] + hi - hi0, hi0)
            rank = rank << 1 | one
        return self.sorted[rank] if len(self.sorted) else np.zeros(len(lo))

    def quantile(self, lo: np.ndarray, hi: np.ndarray, q: float) -> np.ndarray:
        """Interpolated quantile of ``values[lo:hi]``; NaN for an empty range."""
        some = np.flatnonzero(hi > lo)
        out = np.full(len(lo), np.nan)
        at = (hi[some] - lo[some] - 1) * q
        low, high = np.floor(at).astype(np.int64), np.ceil(at).astype(np.int64)
        a, b = (self.smallest(lo[some], hi[some], k) for k in (low, high))
        out[some] = a + (at - low) * (b - a)
        return out


class FirstBelow:
    """The first row of a range whose value is at most a bound: minima of blocks
    of rows, and minima of 2, 4, 8 ... blocks, say which rows can be passed over."""

    STEP = 32

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        pad = -self.n % self.STEP
        self.values = np.concatenate([values, np.full(pad + 1, np.inf)])
        least = self.values[:self.n + pad].reshape(-1, self.STEP).min(axis=1) if self.n else np.empty(0)
        self.minima = [least]
        while len(self.minima[-1]) > 1 << (len(self.minima) - 1):
            size, last = 1 << (len(self.minima) - 1), self.minima[-1]
            self.minima.append(np.minimum(last[:-size], last[size:]))

    def _walk(self, at: np.ndarray, end: np.ndarray, bound: np.ndarray, moving: np.ndarray) -> None:
        """Moves ``at`` row by row to a fitting one, to its end or to a block's begin."""
        while len(moving):
            moving = moving[(at[moving] < end[moving]) & ~(self.values[np.minimum(at[moving], self.n)] <= bound[moving])]
            at[moving] += 1
            moving = moving[at[moving] % self.STEP != 0]

    def find(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """First i in ``lo:hi`` with ``values[i] <= bound``, ``hi`` if there is none."""
        at, hi = np.minimum(np.array(lo, dtype=np.int64), hi), np.asarray(hi, dtype=np.int64)
        everyone = np.arange(len(at))
        self._walk(at, hi, bound, everyone[at % self.STEP != 0])
        edge = np.flatnonzero((at % self.STEP == 0) & (at < hi))
        block = at[edge] // self.STEP
        for level in range(len(self.minima) - 1, -1, -1):
            least, size = self.minima[level], 1 << level
            can = block < len(least)
            skip = np.zeros(len(block), dtype=bool)
            skip[can] = ~(least[block[can]] <= bound[edge[can]])
            block[skip] += size
        at[edge] = np.minimum(block * self.STEP, hi[edge])
        # inside the block that holds one, a begin of a block is where the walk starts
        inside = edge[at[edge] < hi[edge]]
        fits = self.values[at[inside]] <= bound[inside]
        at[inside[~fits]] += 1
        self._walk(at, hi, bound, inside[~fits])
        return np.minimum(at, hi)
