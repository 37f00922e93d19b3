"""Range queries and mergeable moments against loops over the rows."""

import numpy as np
import pytest

from tickwise.functions.moments import mean_std, rolling_moments, window_moments
from tickwise.functions.ranges import FirstBelow, RangeRanks


def ranges(rng, n, m=300):
    lo = rng.integers(0, n + 1, m)
    return lo, np.minimum(lo + rng.integers(0, n + 1, m), n)


@pytest.mark.parametrize("n", [0, 1, 5, 31, 32, 33, 200, 3000])
def test_quantiles_and_first_small_values(n):
    rng = np.random.default_rng(n)
    v = np.round(rng.normal(size=n), 1)
    lo, hi = ranges(rng, n)
    for q in (0.0, 0.5, 0.95, 1.0):
        for a, b, got in zip(lo, hi, RangeRanks(v).quantile(lo, hi, q)):
            assert (a >= b and np.isnan(got)) or got == pytest.approx(np.quantile(v[a:b], q), abs=1e-12)
    bound = rng.normal(size=len(lo)) * 2 - 1.5
    want = [next((i for i in range(a, b) if v[i] <= x), max(a, b) if a > b else b) for a, b, x in zip(lo, hi, bound)]
    assert FirstBelow(v).find(lo, hi, bound).tolist() == want


@pytest.mark.parametrize("n", [0, 1, 7, 500])
def test_moments_beside_outliers(n):
    """An outlier outside a window doesn't touch it, whatever its size."""
    rng = np.random.default_rng(n)
    v = rng.normal(1e-3, 1e-9, n)
    v[rng.random(n) < 0.1] = np.nan
    v[rng.random(n) < 0.05] = 1e15
    lo, hi = ranges(rng, n)
    count, mean, m2 = window_moments(v, lo, hi)
    for a, b, k, x, y in zip(lo, hi, count, mean, m2):
        w = v[a:b][np.isfinite(v[a:b])].astype(np.longdouble)
        assert len(w) == k
        if k > 1 and (w < 1).all():
            assert x == pytest.approx(float(w.mean()), rel=1e-14) and np.sqrt(y / (k - 1)) == pytest.approx(float(w.std(ddof=1)), rel=1e-6)


@pytest.mark.parametrize("include_current", [True, False])
@pytest.mark.parametrize("exact_ties", [True, False])
def test_rolling_rules(include_current, exact_ties):
    rng = np.random.default_rng(2)
    t = np.sort(rng.integers(0, 60, 150))
    v = rng.normal(size=150)
    mean, std = mean_std(rolling_moments(t, v, 10, include_current, exact_ties))
    for i in range(150):
        seen = [j for j in range(150) if t[i] - 10 < t[j] <= t[i] and (j <= i or not exact_ties) and (j != i or include_current)]
        if not seen:
            assert np.isnan(mean[i]) and std[i] == 0
            continue
        assert mean[i] == pytest.approx(v[seen].mean()) and std[i] == pytest.approx(v[seen].std(ddof=1) if len(seen) > 1 else 0, abs=1e-12)


@pytest.mark.parametrize("include_current", [True, False])
@pytest.mark.parametrize("exact_ties", [True, False])
def test_growing_series_answers_as_the_whole_one(include_current, exact_ties):
    from tickwise.functions.moments import GrowingSeries
    rng = np.random.default_rng(8)
    t = np.sort(rng.integers(0, 400, 3000))
    v = np.where(rng.random(3000) < 0.1, np.nan, rng.standard_normal(3000) * 1e-3 + 1e6)
    counted = rng.random(3000) < 0.8
    mean, std = mean_std(rolling_moments(t, v, 37, include_current, exact_ties))
    n = rolling_moments(t, np.where(counted, 0.0, np.nan), 37, include_current, exact_ties)[0]
    series, told = GrowingSeries(), 0
    for lo in range(0, 3000, 170):
        series.add(t[lo:lo + 170], v[lo:lo + 170], counted[lo:lo + 170])
        upto = len(series) if exact_ties and include_current or len(series) == 3000 else int(np.searchsorted(series.t.seen(), series.t.seen()[-1]))
        moments, seen = series.rolling(told, upto, 37, include_current, exact_ties)
        got = mean_std(moments)
        np.testing.assert_allclose(got[0], mean[told:upto], rtol=1e-14)
        np.testing.assert_allclose(got[1], std[told:upto], rtol=1e-6, atol=1e-12)
        np.testing.assert_array_equal(seen, n[told:upto])
        told = upto
    with pytest.raises(ValueError):
        series.add(t[:1] - 1, v[:1], counted[:1])
