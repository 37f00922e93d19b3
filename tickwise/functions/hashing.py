"""Deterministic per-row pseudo-random numbers (partition-independent).

Values depend only on (row key, stream, seed), so a recomputed task after an
executor loss, or a different partitioning, reproduces them exactly.
"""

from __future__ import annotations

import math

import numpy as np

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def splitmix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser on uint64 arrays (wrap-around arithmetic)."""
    with np.errstate(over="ignore"):
        z = x + _GOLD
        z = (z ^ (z >> np.uint64(30))) * _M1
        z = (z ^ (z >> np.uint64(27))) * _M2
        return z ^ (z >> np.uint64(31))


def uniforms(keys: np.ndarray, streams: np.ndarray, seed: int) -> np.ndarray:
    """U(0,1) for every (key, stream) pair: shape (len(keys), len(streams))."""
    k = splitmix64(keys.astype(np.uint64) ^ np.uint64(seed & 0xFFFFFFFFFFFFFFFF))
    s = splitmix64(streams.astype(np.uint64) * _GOLD)
    z = splitmix64(k[:, None] ^ s[None, :])
    return (z >> np.uint64(11)).astype(np.float64) * (1.0 / 9007199254740992.0)


_POISSON1_CDF = np.cumsum([math.exp(-1.0) / math.factorial(k) for k in range(20)])


#: The weight of every value of a hash's first 14 bits; -1 where a step of the distribution lies inside.
_TOP_BITS = 14
_EDGES = np.arange((1 << _TOP_BITS) + 1) / (1 << _TOP_BITS)
_LOW, _HIGH = np.searchsorted(_POISSON1_CDF, _EDGES[:-1], side="right"), np.searchsorted(_POISSON1_CDF, _EDGES[1:], side="left")
_BY_TOP_BITS = np.where(_LOW == _HIGH, _LOW, -1).astype(np.float32)


def poisson1_weights(keys: np.ndarray, n_boot: int, seed: int) -> np.ndarray:
    """Poisson(1) bootstrap weights, shape (rows, n_boot), float32: where the
    ``uniforms`` stand in the distribution. Most are told by their first bits, so
    a table answers them; the hash is taken in place, in two blocks of its size."""
    k = splitmix64(keys.astype(np.uint64) ^ np.uint64(seed & 0xFFFFFFFFFFFFFFFF))
    z = k[:, None] ^ splitmix64(np.arange(n_boot, dtype=np.uint64) * _GOLD)[None, :]
    shifted = np.empty_like(z)
    z += _GOLD
    for bits, factor in ((30, _M1), (27, _M2), (31, None)):
        np.right_shift(z, np.uint64(bits), out=shifted)
        z ^= shifted
        if factor is not None:
            z *= factor
    np.right_shift(z, np.uint64(64 - _TOP_BITS), out=shifted)
    w = _BY_TOP_BITS[shifted.view(np.int64)]
    near = np.flatnonzero(w.ravel() < 0)
    u = (z.ravel()[near] >> np.uint64(11)).astype(np.float64) * (1.0 / 9007199254740992.0)
    w.ravel()[near] = np.searchsorted(_POISSON1_CDF, u, side="right")
    return w



#: Smallest 32-bit numbers that give at least 1, 2, 3 ... of Poisson(1); SQL can count them too.
POISSON1_STEPS = [math.ceil(float(c) * 2**32) for c in _POISSON1_CDF if c * 2**32 < 2**32 - 1]


def md5_poisson1_weights(keys: np.ndarray, n_boot: int, seed: int) -> np.ndarray:
    """As ``poisson1_weights``, from the first 8 digits of md5(seed|key|replicate):
    slower, and reproducible in any SQL engine."""
    from hashlib import md5
    u = np.array([[int(md5(f"{seed}|{k}|{r}".encode()).hexdigest()[:8], 16) for r in range(n_boot)] for k in keys.tolist()], dtype=np.int64)
    return np.searchsorted(POISSON1_STEPS, u.reshape(len(keys), n_boot), side="right").astype(np.float32)


def unit_weights(keys: np.ndarray, n_boot: int, seed: int) -> np.ndarray:
    """Every row once: the metric itself."""
    return np.ones((len(keys), n_boot), dtype=np.float32)
