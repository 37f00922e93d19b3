"""Window statistics from mergeable moments.

A set of values is (n, mean, M2), M2 the sum of squares about its own mean. Two
disjoint sets merge into one without a common centre or scale, so a window's
figures depend on the values inside it alone, however far values outside lie.
While sets merge, a mean is kept as one of the values and the distance from it,
so its error is one of the spread, not of the magnitude.
NumPy helpers for use inside a task, on rows that Spark has brought together.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np

Moments = tuple[np.ndarray, np.ndarray, np.ndarray]


def _merged(a: tuple, b: tuple) -> tuple:
    """Unions of disjoint sets (n, value, distance of the mean from it, M2),
    element by element."""
    n = a[0] + b[0]
    share = b[0] / np.maximum(n, 1)
    some = a[0] > 0
    apart = np.where(some & (b[0] > 0), (b[1] - a[1]) + (b[2] - a[2]), 0.0)
    return (n, np.where(some, a[1], b[1]), np.where(some, a[2] + apart * share, b[2]), a[3] + b[3] + apart * apart * a[0] * share)


def _whole(a: tuple) -> Moments:
    return a[0], a[1] + a[2], a[3]


def _windows(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple:
    fine = np.isfinite(values)
    none = np.zeros(len(values))
    run = (fine.astype(np.int64), np.where(fine, values, 0.0).astype(np.float64), none, none)
    at, left = np.array(lo, dtype=np.int64), np.maximum(np.asarray(hi, dtype=np.int64) - lo, 0)
    out = (np.zeros(len(at), dtype=np.int64), *(np.zeros(len(at)) for _ in range(3)))
    size = 1
    while left.any():
        take = np.flatnonzero(left & size)
        if len(take):
            got = _merged(tuple(x[take] for x in out), tuple(x[at[take]] for x in run))
            for x, new in zip(out, got):
                x[take] = new
            at[take] += size
            left[take] -= size
        run = _merged(tuple(x[:-size] for x in run), tuple(x[size:] for x in run))
        size *= 2
    return out


def window_moments(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Moments:
    """Moments of ``values[lo[i]:hi[i]]`` for every i; NaN and infinities are
    missing. A window is put together from runs of 1, 2, 4 ... values, one for
    each bit of its length: O((rows + windows) log(longest)), O(rows) memory."""
    return _whole(_windows(values, lo, hi))


def rolling_moments(t: np.ndarray, values: np.ndarray, width: int, include_current: bool = True, exact_ties: bool = False) -> Moments:
    """Moments over ``(t - width, t]`` per row, rows sorted by ``t``. Rows of one
    tick see each other; with ``exact_ties`` a row sees only those before it.
    Without ``include_current`` a row does not see itself."""
    rows = np.arange(len(t))
    lo = np.searchsorted(t, t - width, side="right")
    hi = rows + 1 if exact_ties else np.searchsorted(t, t, side="right")
    if include_current:
        return window_moments(values, lo, hi)
    return _whole(_merged(_windows(values, lo, rows), _windows(values, rows + 1, hi)))


class _Grown:
    """A NumPy array that grows at its end."""

    def __init__(self, dtype: type):
        self.held, self.size = np.empty(1024, dtype=dtype), 0

    def add(self, values: np.ndarray) -> None:
        size = self.size + len(values)
        if size > len(self.held):
            held = np.empty(max(size, len(self.held) + len(self.held) // 2), dtype=self.held.dtype)
            held[:self.size] = self.held[:self.size]
            self.held = held
        self.held[self.size:size] = values
        self.size = size

    def seen(self) -> np.ndarray:
        return self.held[:self.size]


class GrowingSeries:
    """Rolling figures of a series that comes in time order, block by block: per
    row its tick, the count so far and moments of aligned runs of 2, 4, 8 ...
    values, about 60 bytes whatever else the rows hold."""

    def __init__(self):
        self.t, self.values, self.counts = _Grown(np.int64), _Grown(np.float64), _Grown(np.int64)
        self.counts.add(np.zeros(1, dtype=np.int64))
        self.runs: list[tuple[_Grown, ...]] = []

    def __len__(self) -> int:
        return self.t.size

    def add(self, t: np.ndarray, values: np.ndarray, counted: np.ndarray) -> None:
        if len(t) and (np.any(t[1:] < t[:-1]) or len(self) and t[0] < self.t.seen()[-1]):
            raise ValueError("rows are not in time order")
        self.t.add(t)
        self.values.add(values)
        self.counts.add(self.counts.seen()[-1] + np.cumsum(counted))
        level = 0
        while self._size(level) >= 2:
            if level == len(self.runs):
                self.runs.append((_Grown(np.int32), *(_Grown(np.float64) for _ in range(3))))
            fresh = np.arange(self.runs[level][0].size, self._size(level) // 2) * 2
            for held, new in zip(self.runs[level], _merged(self._take(level, fresh), self._take(level, fresh + 1))):
                held.add(new)
            level += 1

    def _size(self, level: int) -> int:
        return self.runs[level - 1][0].size if level else self.values.size

    def _take(self, level: int, at: np.ndarray) -> tuple:
        """Runs of 2 ** level values, as ``_merged`` takes them."""
        if level:
            n, *rest = (x.seen()[at] for x in self.runs[level - 1])
            return n.astype(np.int64), *rest
        values = self.values.seen()[at]
        fine, none = np.isfinite(values), np.zeros(len(at))
        return fine.astype(np.int64), np.where(fine, values, 0.0), none, none

    def _windows(self, lo: np.ndarray, hi: np.ndarray) -> tuple:
        lo, hi = np.array(lo, dtype=np.int64), np.maximum(hi, lo)
        out = (np.zeros(len(lo), dtype=np.int64), *(np.zeros(len(lo)) for _ in range(3)))
        level = 0
        while (lo < hi).any():
            for side, step in ((lo, 0), (hi, 1)):
                take = np.flatnonzero((lo < hi) & (side & 1 == 1))
                if len(take):
                    got = _merged(tuple(x[take] for x in out), self._take(level, side[take] - step))
                    for x, new in zip(out, got):
                        x[take] = new
                    side[take] += 1 - 2 * step
            lo >>= 1
            hi >>= 1
            level += 1
        return out

    def rolling(self, start: int, stop: int, width: int, include_current: bool, exact_ties: bool) -> tuple[Moments, np.ndarray]:
        """``rolling_moments`` of the rows ``start`` to ``stop``, and how many rows
        of their windows count. All rows of their ticks have come, unless
        ``exact_ties``."""
        t, rows = self.t.seen(), np.arange(start, stop)
        lo = np.searchsorted(t, t[start:stop] - width, side="right")
        hi = rows + 1 if exact_ties else np.searchsorted(t, t[start:stop], side="right")
        n = self.counts.seen()[hi] - self.counts.seen()[lo]
        if include_current:
            return _whole(self._windows(lo, hi)), n
        own = np.diff(self.counts.seen()[start:stop + 1])
        return _whole(_merged(self._windows(lo, rows), self._windows(rows + 1, hi))), n - own


def mean_std(m: Moments) -> tuple[np.ndarray, np.ndarray]:
    """Mean (NaN without values) and sample deviation (0 below two values)."""
    n, mean, m2 = m
    return np.where(n > 0, mean, np.nan), np.sqrt(np.where(n > 1, m2 / np.maximum(n - 1, 1), 0.0))


def rolling_columns(t: np.ndarray, values: np.ndarray, counted: np.ndarray, windows: Mapping[str, int], include_current: bool,
                    exact_ties: bool, names: tuple[str, str, str], value_col: str) -> dict[str, np.ndarray]:
    """Mean, deviation and count columns of every window. ``counted``: whether a
    row counts (its count column isn't null)."""
    out = {}
    seen = np.where(counted, 0.0, np.nan)
    for label, width in windows.items():
        mean, std = mean_std(rolling_moments(t, values, width, include_current, exact_ties))
        n = rolling_moments(t, seen, width, include_current, exact_ties)[0]
        for name, column in zip(names, (mean, std, n.astype(np.float64))):
            out[name.format(v=value_col, w=label)] = column
    return out
