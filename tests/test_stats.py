"""Statistics operators: distributed quantiles, Welch test, bootstraps,
histograms, correlations, profiles."""

import numpy as np
import pandas as pd
import pytest

from tickwise.functions.dist import student_t_two_sided_p
from tickwise.operators import stats as S


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 999, p=[0.9, 0.1]), "v": rng.integers(0, 50, 999) * 1.0})
    pdf.loc[::17, "v"] = np.nan
    got = S.exact_quantiles(spark.createDataFrame(pdf), "v", [0.0, 0.25, 0.5, 0.95, 1.0], ["g"]).toPandas()
    for _, r in got.iterrows():
        x = pdf[pdf.g == r.g].v.dropna().to_numpy()
        np.testing.assert_allclose([r.q0, r.q1, r.q2, r.q3, r.q4], np.percentile(x, [0, 25, 50, 95, 100]))


def test_describe_and_box(spark):
    pdf = pd.DataFrame({"g": ["a"] * 5 + ["b"] * 4, "v": [1.0, 2, 3, 4, 100, 5, 6, 7, 8]})
    d = S.describe(spark.createDataFrame(pdf), ["v"], by=["g"]).toPandas().set_index("g")
    exp = pdf.groupby("g").v.describe()
    for g in ("a", "b"):
        np.testing.assert_allclose(d.loc[g, ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]].astype(float),
                                   exp.loc[g].to_numpy())
    b = S.box_summary(spark.createDataFrame(pdf), "g", "v").toPandas().set_index("g")
    assert b.loc["a", "n_outliers"] == 1 and b.loc["a", "whisker_hi"] == 4.0


def test_welch_matches_known_values(spark):
    np.testing.assert_allclose(student_t_two_sided_p([2.0, 1.0, 3.0], [10, 5, 100]),
                               [0.0733880347, 0.3632174, 0.0034079], rtol=1e-5)
    a = [1.0, 2.0, 3.0, 4.0, 5.0]
    b = [2.0, 4.0, 6.0, 8.0, 10.0, 12.0]
    pdf = pd.DataFrame({"g": 1, "arm": ["a"] * 5 + ["b"] * 6, "v": a + b})
    r = S.welch_test(spark.createDataFrame(pdf), ["g"], "arm", "v", "a", "b").toPandas().iloc[0]
    va, vb = np.var(a, ddof=1) / 5, np.var(b, ddof=1) / 6
    t = (np.mean(a) - np.mean(b)) / np.sqrt(va + vb)
    dof = (va + vb) ** 2 / (va ** 2 / 4 + vb ** 2 / 5)
    assert r.t_stat == pytest.approx(t) and r.dof == pytest.approx(dof)
    assert r.p_value == pytest.approx(float(student_t_two_sided_p([t], [dof])[0]))


def test_bootstrap_cis(spark):
    rng = np.random.default_rng(1)
    n = 400
    pdf = pd.DataFrame({"k": np.arange(2 * n), "arm": ["t"] * n + ["c"] * n,
                        "v": np.r_[rng.normal(1.0, 1, n), rng.normal(0.0, 1, n)], "g": "x"})
    ci = S.bootstrap_mean_diff_ci(spark.createDataFrame(pdf), ["g"], "arm", "v", "k", "t", "c", n_boot=400)
    r = ci.toPandas().iloc[0]
    obs = pdf[pdf.arm == "t"].v.mean() - pdf[pdf.arm == "c"].v.mean()
    assert r.ci_lower < obs < r.ci_upper and 0.1 < r.ci_upper - r.ci_lower < 0.5
    pairs = pd.DataFrame({"k": np.arange(n), "a": rng.normal(0.5, 1, n)}).assign(b=lambda d: d.a - 0.5)
    pr = S.bootstrap_paired(spark.createDataFrame(pairs), [], "a", "b", "k", n_boot=300, with_p=True).toPandas().iloc[0]
    assert pr["diff"] == pytest.approx(0.5) and pr.ci_lower == pytest.approx(0.5) and pr.p_value == 0.0


def test_histogram_and_corr(spark):
    pdf = pd.DataFrame({"x": [0.0, 1, 2, 3, 4, 10], "y": [1.0, 2, 3, 4, 5, None]})
    h = S.histogram(spark.createDataFrame(pdf), "x", 5).toPandas().sort_values("bin")
    exp, _ = np.histogram(pdf.x, bins=5)
    assert list(h["count"]) == list(exp)
    c = S.corr_pairs(spark.createDataFrame(pdf), ["x", "y"]).toPandas()
    assert c.r.iloc[0] == pytest.approx(pdf.x.corr(pdf.y))


def test_missing_and_profile(spark):
    pdf = pd.DataFrame({"a": [1.0, None, np.nan], "b": ["x", None, "z"]})
    m = S.missing_summary(spark.createDataFrame(pdf)).toPandas().set_index("column")
    assert m.loc["a", "missing"] == 2 and m.loc["b", "missing"] == 1 and m.loc["a", "pct"] == 66.67
    p = S.profile(spark.createDataFrame(pdf), "t").toPandas()
    assert set(p.columns) >= {"table", "n_rows", "n_columns", "column", "dtype", "missing", "non_null"}


@pytest.mark.parametrize("few", [0, 10**6])
def test_column_quantiles_match_numpy(spark, few):
    rng = np.random.default_rng(5)
    n = 4001
    pdf = pd.DataFrame({"id": range(n), "a": rng.standard_normal(n), "tied": rng.integers(0, 3, n).astype(float), "one": 7.0,
                        "wide": np.where(rng.random(n) < 0.2, np.inf, rng.random(n)), "holes": np.where(rng.random(n) < 0.4, np.nan, rng.random(n))})
    df = spark.createDataFrame(pdf).repartition(5).selectExpr("*", "cast(null as double) nothing", "if(id < 2, id, null) pair")
    names = ["a", "tied", "one", "wide", "holes"]
    for q in (0.0, 0.5, 0.93, 1.0):
        got = S.column_quantiles(df, [*names, "nothing", "pair"], q, few=few)
        assert got["nothing"] is None and got["pair"] == q
        for c in names:
            v = np.sort(pdf[c].dropna().to_numpy())
            h = (len(v) - 1) * q
            lo, hi = v[int(np.floor(h))], v[int(np.ceil(h))]
            np.testing.assert_equal(got[c], lo + (h - np.floor(h)) * (hi - lo))
