"""Metric bootstraps against weighted metrics computed replicate by replicate."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickwise.functions.hashing import POISSON1_STEPS, md5_poisson1_weights, poisson1_weights
from tickwise.operators import bootstrap as B
from tickwise.operators import stats as S


def auc(y, s, w):
    pos, neg = w * y, w * (1 - y)
    wins = (s[:, None] > s[None]) + 0.5 * (s[:, None] == s[None])
    return float(pos @ wins @ neg) / (pos.sum() * neg.sum())


def f1(y, p, w):
    tp, fp, fn = (float((w * ((y == a) & (p == b))).sum()) for a, b in ((1, 1), (0, 1), (1, 0)))
    return 2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0


def mae(y, p, w):
    return float((w * np.abs(y - p)).sum() / w.sum())


def by_loop(pdf, y, a, b, metric, n_boot, seed=42):
    w = poisson1_weights(pdf["id"].to_numpy(), n_boot, seed).astype(float)
    v, one = pdf[y].to_numpy(dtype=float), np.ones(len(pdf))
    p, q = pdf[a].to_numpy(dtype=float), pdf[b].to_numpy(dtype=float)
    d = np.array([metric(v, p, w[:, r]) - metric(v, q, w[:, r]) for r in range(n_boot)])
    seen = metric(v, p, one) - metric(v, q, one)
    return [len(pdf), metric(v, p, one), metric(v, q, one), seen, *np.quantile(d, [0.025, 0.975]), np.mean(d >= 0 if seen <= 0 else d <= 0)]


@pytest.fixture(scope="module")
def scores():
    rng = np.random.default_rng(3)
    n = 400
    y = rng.integers(0, 2, n)
    # scores with many ties, one hot value held by a third of the rows
    s = np.where(rng.random(n) < 0.33, 0.5, np.round(rng.random(n) + 0.2 * y, 1))
    t = np.round(rng.random(n) + 0.1 * y, 2)
    return pd.DataFrame({"id": np.arange(n), "g": rng.integers(0, 2, n), "y": y, "s": s, "t": t, "cs": (s > 0.6).astype(int), "ct": (t > 0.6).astype(int)})


@pytest.mark.parametrize("name,metric,loop,cols", [("auc", B.AUC, auc, ("s", "t")), ("f1", B.F1, f1, ("cs", "ct")), ("mae", B.MAE, mae, ("s", "t"))])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_metrics_equal_a_loop(spark, scores, name, metric, loop, cols, by, monkeypatch):
    monkeypatch.setattr(B, "CHUNK_ROWS", 37)
    df = spark.createDataFrame(scores).repartition(5)
    got = B.metric_bootstrap(df, "y", cols, metric, "id", by=by, n_boot=30, target_rows=60).toPandas()
    for _, r in got.iterrows():
        part = scores[scores.g == r.g] if by else scores
        np.testing.assert_allclose(r[["n", "metric_a", "metric_b", "diff", "ci_lower", "ci_upper", "p_value"]].to_numpy(dtype=float),
                                   by_loop(part, "y", *cols, loop, 30), rtol=1e-9, atol=1e-12)
    assert len(got) == (2 if by else 1)


def test_own_metric_and_missing_rows(spark, scores):
    own = B.SumMetric(lambda y, p: {"bias": y - p}, lambda s: s["bias"] / s["w"])
    odd = scores.copy()
    odd.loc[:4, "s"] = np.nan
    r = B.metric_bootstrap(spark.createDataFrame(odd), "y", ("s", "t"), own, "id", n_boot=20).first()
    left = odd.dropna()
    assert r.n == len(left) and r.metric_a == pytest.approx((left.y - left.s).mean())
    with pytest.raises(ValueError):
        B.metric_bootstrap(spark.createDataFrame(scores), "y", ("s", "t"), "gini", "id")
    # one class only: no AUC
    one = B.metric_bootstrap(spark.createDataFrame(scores[scores.y == 1]), "y", ("s", "t"), B.AUC, "id", n_boot=5).first()
    assert one.metric_a is None and one.ci_lower is None


def test_many_groups_are_passed_on_in_parts(spark, scores, monkeypatch):
    df = spark.createDataFrame(scores.assign(g=scores.id % 50)).repartition(2)
    whole = S.weighted_partials(df, ["g"], "id", ["s"], 10, 1).toPandas().sort_values(["g", "rep"], ignore_index=True)
    monkeypatch.setattr(S, "HELD_SUMS", 30)
    parts = S.weighted_partials(df, ["g"], "id", ["s"], 10, 1).toPandas().sort_values(["g", "rep"], ignore_index=True)
    pd.testing.assert_frame_equal(whole, parts)


def test_md5_weights_are_poisson_and_countable(spark):
    w = md5_poisson1_weights(np.arange(3000), 4, 7)
    assert abs(w.mean() - 1) < 0.05 and abs(w.var() - 1) < 0.1
    u = int(spark.range(1).select(F.conv(F.substring(F.md5(F.lit("7|5|2")), 1, 8), 16, 10).alias("u")).first().u)
    assert w[5, 2] == sum(s <= u for s in POISSON1_STEPS)


def test_poisson_weights_are_the_steps_of_their_uniforms():
    from tickwise.functions.hashing import _POISSON1_CDF, uniforms
    keys = np.concatenate([np.arange(300), [-1, 2**62, -2**63]])
    for n_boot, seed in ((2000, 42), (3, 7961), (0, 1)):
        u = uniforms(keys, np.arange(n_boot, dtype=np.uint64), seed)
        np.testing.assert_array_equal(poisson1_weights(keys, n_boot, seed), np.searchsorted(_POISSON1_CDF, u, side="right"))
    assert poisson1_weights(keys[:0], 5, 1).shape == (0, 5)


def test_bootstrap_blocks_are_small_and_use_every_core(spark):
    import tracemalloc
    rows = S.chunk_rows(2000)
    tracemalloc.start()
    poisson1_weights(np.arange(rows), 2000, 42)
    assert tracemalloc.get_traced_memory()[1] < 16 << 20
    tracemalloc.stop()
    df = spark.range(4000).select("id", F.lit(0).alias("g"), (F.col("id") % 7).cast("double").alias("s")).coalesce(1)
    one = S.dealt(df, ["id", "s"])
    assert one.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    got = S.weighted_partials(df, ["g"], "id", ["s"], 6, 1).orderBy("rep").toPandas()
    w = poisson1_weights(np.arange(4000), 6, 1).astype(float)
    np.testing.assert_allclose(got["sw"], w.sum(axis=0))
    np.testing.assert_allclose(got["s_s"], (np.arange(4000) % 7) @ w)
