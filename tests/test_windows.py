"""Rolling / lag / sequence / resample operators against pandas."""

import numpy as np
import pandas as pd
import pytest

from tickwise.functions.expr import nan_to_null
from tickwise.operators.features import RollingLagFeatures
from tickwise.operators.window import (grouped_bin_counts, lag_features, resample, rolling_time_stats,
                                       sliding_sequences)


def _series(n=400, seed=3, null_frac=0.05):
    rng = np.random.default_rng(seed)
    t = np.sort(rng.choice(np.arange(0, 40_000), n, replace=False)).astype(np.int64)
    v = rng.uniform(50, 150, n)
    v[rng.random(n) < null_frac] = np.nan
    return pd.DataFrame({"rid": np.arange(n), "t": t, "v": v})




@pytest.mark.parametrize("strategy", ["fixed", "depth", "moments"])
def test_rolling_matches_pandas_on_unique_ticks(spark, strategy):
    pdf = _series()
    windows = {"a": 500, "b": 3000}
    sdf = nan_to_null(spark.createDataFrame(pdf))
    got = rolling_time_stats(sdf, "t", "v", windows, bucket_width=3000, strategy=strategy,
                             target_rows=37).toPandas().sort_values("t")
    s = pdf.set_index(pd.to_datetime(pdf.t, unit="ns"))["v"]
    for lab, w in windows.items():
        r = s.rolling(f"{w}ns", min_periods=1)
        np.testing.assert_allclose(got[f"v_roll_mean_{lab}"].to_numpy(dtype=float), r.mean().to_numpy(), rtol=1e-9)
        np.testing.assert_allclose(got[f"v_roll_std_{lab}"].to_numpy(dtype=float), r.std().fillna(0).to_numpy(),
                                   rtol=1e-7, atol=1e-9)
        np.testing.assert_allclose(got[f"rate_{lab}"].to_numpy(dtype=float), r.count().to_numpy())


def test_lags_backfill_match_pandas_with_nulls(spark):
    from pyspark.sql import functions as F
    pdf = _series(300, seed=5, null_frac=0.2)
    sdf = spark.createDataFrame(pdf).withColumn("v", F.nanvl("v", F.lit(None)))
    lags = [1, 2, 5]
    got = lag_features(sdf, ["t", "rid"], "v", lags, bucket_rows=16).toPandas().sort_values("row_idx")
    exp = pdf.sort_values("t").reset_index(drop=True)
    cols = [f"v_lag_{k}" for k in lags]
    for k in lags:
        exp[f"v_lag_{k}"] = exp["v"].shift(k)
    exp[cols] = exp[cols].bfill().fillna(0.0)
    np.testing.assert_allclose(got[cols].to_numpy(dtype=float), exp[cols].to_numpy(dtype=float))


def test_keyed_lags_cross_bucket_boundaries(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"rid": np.arange(500), "k": rng.integers(0, 3, 500), "t": rng.permutation(500),
                        "v": rng.normal(size=500)})
    got = lag_features(spark.createDataFrame(pdf), ["t", "rid"], "v", [1, 3], partition_by=["k"],
                       backfill=False, fill_value=None, bucket_rows=7).toPandas()
    exp = pdf.sort_values(["k", "t"]).copy()
    exp["e1"] = exp.groupby("k")["v"].shift(1)
    exp["e3"] = exp.groupby("k")["v"].shift(3)
    m = got.merge(exp, on="rid")
    assert ((m.v_lag_1.isna() & m.e1.isna()) | np.isclose(m.v_lag_1, m.e1)).all()
    assert ((m.v_lag_3.isna() & m.e3.isna()) | np.isclose(m.v_lag_3, m.e3)).all()


def test_transformer_reference_fixtures(spark):
    # 100 rows one second apart (reference feature test): every column present, no nulls
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"timestamp_ns": np.arange(100) * 1_000_000_000, "latency_us": rng.uniform(50, 150, 100),
                        "packet_size_bytes": rng.integers(64, 1500, 100)})
    tr = RollingLagFeatures(count_col="packet_size_bytes", rate_name="packet_rate_{w}")
    out = tr.transform(spark.createDataFrame(pdf)).toPandas()
    for name in tr.feature_names():
        assert name in out.columns and out[name].notna().all()
    assert "latency_us_roll_mean_1s" in out.columns and "latency_us_lag_10" in out.columns
    small = tr.transform(spark.createDataFrame(pdf.head(20))).toPandas()
    assert not small[tr.feature_names()].isna().any().any()
    single = tr.transform(spark.createDataFrame(pdf.head(1))).toPandas()
    assert len(single) == 1 and single["latency_us_roll_std_1s"].iloc[0] == 0.0


def test_sequences_per_key(spark):
    pdf = pd.DataFrame({"k": [1] * 6 + [2] * 2, "t": list(range(6)) + [0, 1], "v": [float(i) for i in range(8)]})
    got = sliding_sequences(spark.createDataFrame(pdf), ["t"], ["v"], 3, target_col="v", partition_by=["k"],
                            bucket_rows=2).toPandas().sort_values("row_idx")
    assert list(got.k) == [1, 1, 1, 1]          # key 2 has fewer rows than the window
    assert got.seq.iloc[0] == [0.0, 1.0, 2.0] and got.target.iloc[-1] == 5.0


def test_resample_emits_empty_bins(spark):
    pdf = pd.DataFrame({"t": [0, 5, 35, 36], "v": [1.0, 3.0, 5.0, 7.0]})
    from pyspark.sql import functions as F
    got = resample(spark.createDataFrame(pdf), "t", 10, {"mean_v": F.avg("v"), "n": F.count("v")}).toPandas()
    got = got.sort_values("bin_start")
    assert list(got.bin_start) == [0, 10, 20, 30]
    assert list(got.n) == [2, 0, 0, 2] and got.mean_v.isna().sum() == 2


def test_grouped_bin_counts_pivot(spark):
    pdf = pd.DataFrame({"g": ["a", "a", "b"], "t": [0, 25, 10]})
    got = grouped_bin_counts(spark.createDataFrame(pdf), "g", "t", 10).toPandas().sort_values("bin_start")
    assert list(got.bin_start) == [0, 10, 20]
    assert list(got.a) == [1, 0, 1] and list(got.b) == [0, 1, 0]


def test_rolling_depth_keyed_with_peers(spark):
    # duplicate ticks: RANGE peers see each other in both strategies
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"k": rng.integers(0, 3, 600), "t": rng.integers(0, 300, 600), "v": rng.normal(size=600)})
    sdf = spark.createDataFrame(pdf)
    a = rolling_time_stats(sdf, "t", "v", {"w": 40}, partition_by=["k"], strategy="fixed").toPandas()
    b = rolling_time_stats(sdf, "t", "v", {"w": 40}, partition_by=["k"], strategy="depth", target_rows=25).toPandas()
    key = ["k", "t", "v"]
    a, b = a.sort_values(key).reset_index(drop=True), b.sort_values(key).reset_index(drop=True)
    for c in ("v_roll_mean_w", "v_roll_std_w", "rate_w"):
        np.testing.assert_allclose(a[c].to_numpy(dtype=float), b[c].to_numpy(dtype=float), rtol=1e-9, atol=1e-12)


@pytest.mark.parametrize("strategy", ["fixed", "depth", "moments"])
@pytest.mark.parametrize("offset,scale", [(0, 1), (1e9, 0.1), (1e5, 0.01), (0, 1e-7), (0, 1e-13), (1e14, 1e3)])
def test_rolling_std_at_any_magnitude(spark, strategy, offset, scale):
    """The spread of a window is kept whatever the values' size."""
    rng = np.random.default_rng(0)
    t = np.sort(rng.integers(0, 3000, 200))
    v = offset + rng.standard_normal(200) * scale
    df = spark.createDataFrame(pd.DataFrame({"t": t, "i": range(200), "v": v}))
    got = rolling_time_stats(df, "t", "v", {"w": 60}, strategy=strategy, target_rows=50).orderBy("i").toPandas()
    own = [v[(t > x - 60) & (t <= x)] for x in t]
    want = np.array([w.std(ddof=1) if len(w) > 1 else 0.0 for w in own])
    assert np.abs(got.v_roll_std_w - want).max() < 1e-6 * scale
    assert np.allclose(got.v_roll_mean_w, [w.mean() for w in own], rtol=1e-12)


def test_rolling_skips_values_that_are_no_numbers(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, 3.0), (4, None), (5, float("inf"))], "t long, v double")
    got = {r.t: (r.v_roll_mean_w, r.v_roll_std_w) for r in rolling_time_stats(df, "t", "v", {"w": 10}).collect()}
    assert got[5][0] == pytest.approx(2.0) and got[5][1] == pytest.approx(2 ** 0.5) and got[2][0] == 1.0


@pytest.mark.parametrize("include", [True, False])
@pytest.mark.parametrize("ties", [True, False])
@pytest.mark.parametrize("how", ["moments", "split", "depth"])
def test_rolling_options_on_equal_ticks(spark, include, ties, how):
    """Keyed rows with ties and nulls; ``split``: a dense bucket is left to the
    running totals."""
    from tickwise.functions.moments import mean_std, rolling_moments
    rng = np.random.default_rng(6)
    n = 240
    t = np.sort(np.where(rng.random(n) < 0.4, rng.integers(500, 620, n), rng.integers(0, 3000, n)))
    pdf = pd.DataFrame({"rid": np.arange(n), "k": rng.integers(0, 2, n), "t": t, "v": rng.uniform(50, 150, n), "note": [f"r{i}" for i in range(n)]})
    pdf.loc[rng.random(n) < 0.1, "v"] = np.nan
    sdf = nan_to_null(spark.createDataFrame(pdf)).repartition(4)
    extra = {"moments": {}, "split": {"span_rows": 60}, "depth": {"strategy": "depth", "target_rows": 17}}[how]
    got = rolling_time_stats(sdf, "t", "v", {"w": 100, "x": 400}, partition_by=["k"], include_current=include, exact_ties=ties, tie_col="rid", **extra)
    assert got.columns[:5] == ["rid", "k", "t", "v", "note"]
    got = got.toPandas().set_index("rid")
    assert len(got) == n and (got.note == [f"r{i}" for i in got.index]).all()
    for _, part in pdf.groupby("k"):
        for lab, w in (("w", 100), ("x", 400)):
            m = rolling_moments(part.t.to_numpy(), part.v.to_numpy(), w, include, ties)
            mean, std = mean_std(m)
            rows = got.loc[part.rid]
            np.testing.assert_allclose(rows[f"v_roll_mean_{lab}"].to_numpy(dtype=float), mean, rtol=1e-9)
            np.testing.assert_allclose(rows[f"v_roll_std_{lab}"].to_numpy(dtype=float), std, rtol=1e-7, atol=1e-8)
            np.testing.assert_allclose(rows[f"rate_{lab}"].to_numpy(dtype=float), m[0])


def test_rolling_beside_a_far_outlier(spark):
    """Windows without the outlier keep a spread of 1e-6 beside 1e15."""
    rng = np.random.default_rng(1)
    v = 5.0 + rng.normal(0, 1e-6, 300)
    v[150] = 1e15
    sdf = spark.createDataFrame(pd.DataFrame({"t": np.arange(300) * 10, "v": v}))
    got = rolling_time_stats(sdf, "t", "v", {"w": 100}).toPandas().sort_values("t")
    want = pd.Series(v).rolling(10, min_periods=1).apply(lambda x: np.std(x, ddof=1) if len(x) > 1 else 0.0)
    calm = np.r_[0:150, 160:300]
    np.testing.assert_allclose(got.v_roll_std_w.to_numpy()[calm], want.to_numpy()[calm], rtol=1e-5)


@pytest.mark.parametrize("exact_ties", [True, False])
def test_rolling_buckets_are_answered_in_parts(spark, monkeypatch, exact_ties):
    from pyspark.sql import functions as F
    from tickwise.operators import window
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"i": np.arange(900), "g": rng.integers(0, 2, 900), "t": rng.integers(0, 120, 900), "v": rng.random(900).round(3)})
    df = spark.createDataFrame(pdf).withColumn("t", F.when(F.col("i") % 90 != 0, F.col("t")))
    ask = lambda: window.rolling_time_stats(
        df, "t", "v", {"a": 7, "b": 40}, partition_by=["g"], exact_ties=exact_ties, tie_col="i").orderBy("i").toPandas()
    whole = ask()
    monkeypatch.setattr(window, "ANSWERED_ROWS", 16)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        parts = ask()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    pd.testing.assert_frame_equal(whole, parts)
    assert len(parts) == 900 and parts.rate_b[parts.t.isna()].eq(0).all() and parts.v_roll_mean_b[parts.t.isna()].isna().all()


def test_lag_buckets_are_shared_out(spark):
    from tickwise.operators.window import DEFAULT_INDEX_BUCKET, _bucket_rows
    df, parts = spark.range(1), int(spark.conf.get("spark.sql.shuffle.partitions"))
    for n in (6_000_000, 600_000):
        assert n / _bucket_rows(df, n) >= min(4 * parts, n / DEFAULT_INDEX_BUCKET) and _bucket_rows(df, n) <= DEFAULT_INDEX_BUCKET
    assert 600_000 / _bucket_rows(df, 600_000) >= 4 * parts and _bucket_rows(df, 10**12) == DEFAULT_INDEX_BUCKET
