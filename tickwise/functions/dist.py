"""Student-t tail probabilities without SciPy (vectorised NumPy).

With ``s = sqrt(dof) * tan(u)`` the t density becomes ``cos(u)^(dof - 1)`` up to
its total over (-pi/2, pi/2), so the two-sided p of ``t`` is twice the share
beyond ``atan(t / sqrt(dof))``. Written in ``w = pi/2 - u`` the integrand is
``sin(w)^(dof - 1)``, which falls from its value at the upper end; it is
integrated by Gauss-Legendre panels over the part that matters to 16 digits.
"""

from __future__ import annotations

import math

import numpy as np

_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(48)
_PANELS = 4
_NEGLIGIBLE = 45.0          # e^-45 of the largest value
_POWER = 4                  # w = z^4 smooths the end at w = 0, where the power of sin may be a fraction


def _log_total(dof: np.ndarray) -> np.ndarray:
    """log of the integral of cos(u)^(dof - 1) over (-pi/2, pi/2)."""
    half = np.array([math.lgamma(d / 2) - math.lgamma((d + 1) / 2) if d < 1e7 else -0.5 * math.log(d / 2) + 0.25 / d
                     for d in np.ravel(dof)]).reshape(np.shape(dof))
    return 0.5 * math.log(math.pi) + half


def student_t_two_sided_p(t, dof) -> np.ndarray:
    """P(|T| >= |t|) for Student t with ``dof`` degrees of freedom."""
    t, dof = np.broadcast_arrays(np.abs(np.asarray(t, dtype=float)), np.asarray(dof, dtype=float))
    out = np.full(t.shape, np.nan)
    ok = (dof > 0) & np.isfinite(dof) & ~np.isnan(t)
    out[ok & np.isinf(t)] = 0.0
    ok &= np.isfinite(t)
    if not ok.any():
        return out
    x, d = t[ok], dof[ok]
    top = np.arctan2(np.sqrt(d), x)                       # w at the quantile
    log_top = -0.5 * np.log1p(x * x / d)                  # log sin(top)
    # the lower end: where the integrand has fallen to e^-45, or 0
    with np.errstate(divide="ignore", over="ignore"):
        drop = np.where(d > 1, _NEGLIGIBLE / np.maximum(d - 1, 1e-300), np.inf)
    low = np.arcsin(np.exp(np.maximum(log_top - drop, -745.0)))
    z0, z1 = low ** (1 / _POWER), top ** (1 / _POWER)
    z0 = np.where(d > 1, z0, 0.0)
    total = np.zeros_like(x)
    for k in range(_PANELS):
        a, b = z0 + (z1 - z0) * k / _PANELS, z0 + (z1 - z0) * (k + 1) / _PANELS
        z = a[:, None] + (b - a)[:, None] * (_NODES[None] + 1) / 2
        w = z ** _POWER
        # log sin(w), exact also where w is near pi/2 (large dof)
        near_zero = w < 1
        log_sin = np.where(near_zero, np.log(np.sin(np.minimum(w, 1.0))), 0.5 * np.log1p(-np.cos(np.where(near_zero, 1.0, w)) ** 2))
        value = np.exp((d - 1)[:, None] * (log_sin - log_top[:, None])) * _POWER * z ** (_POWER - 1)
        total += (value * _WEIGHTS[None]).sum(axis=1) * (b - a) / 2
    log_p = math.log(2) + np.log(total) + (d - 1) * log_top - _log_total(d)
    out[ok] = np.minimum(np.exp(log_p), 1.0)
    return out
