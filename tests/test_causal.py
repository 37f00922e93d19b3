"""Event windows (J6/J7), pre/post study (K1 + W6) and DiD inputs against a
NumPy searchsorted loop written from the semantics."""

import numpy as np
import pandas as pd

from tickwise.operators import causal as K
from tickwise.operators.rangejoin import control_centre


def _loop(ts, lat, centres, w, min_pts=5, smooth=5):
    out = {}
    for eid, t in centres:
        lo = np.searchsorted(ts, t - w, "left")
        mid = np.searchsorted(ts, t, "left")
        hi = np.searchsorted(ts, t + w, "right")
        pre, post = lat[lo:mid], lat[mid + 1:hi]
        if len(pre) < min_pts or len(post) < min_pts:
            continue
        pm = pre.mean()
        seg, st = lat[mid + 1:hi], ts[mid + 1:hi]
        rt = None
        for i in range(smooth - 1, len(seg)):
            if seg[i - smooth + 1:i + 1].mean() <= pm:
                rt = st[i] - t
                break
        if rt is None:
            rt = st[-1] - t
        out[eid] = (pm, post.mean(), np.percentile(pre, 95), np.percentile(post, 95), len(pre), len(post), rt)
    return out


def test_pre_post_matches_loop(spark):
    rng = np.random.default_rng(11)
    n = 1500
    ts = np.sort(rng.integers(0, 60_000, n))                   # duplicate ticks on purpose
    lat = rng.normal(100, 10, n)
    series = pd.DataFrame({"rid": np.arange(n), "t": ts, "lat": lat})
    ev_idx = rng.choice(n, 60, replace=False)
    centres = [(int(i), int(ts[i]) + (int(i) % 3) * 7) for i in ev_idx]   # some centres off-tick
    events = pd.DataFrame({"eid": [c[0] for c in centres], "tc": [c[1] for c in centres]})
    exp = _loop(ts, lat, centres, 2_000)
    got = K.pre_post(spark.createDataFrame(series), spark.createDataFrame(events), t_col="t", tie_col="rid",
                     value_col="lat", event_key="eid", event_t="tc", half_width=2_000).toPandas().set_index("eid")
    assert set(got.index) == set(exp)
    for eid, (pm, qm, pp, qp, npre, npost, rt) in exp.items():
        r = got.loc[eid]
        assert r.pre_n == npre and r.post_n == npost
        np.testing.assert_allclose([r.pre_mean, r.post_mean, r.pre_p95, r.post_p95, r.restoration_time],
                                   [pm, qm, pp, qp, rt], rtol=1e-9)


def test_did_control_shift(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(pd.DataFrame({"t": [5, 100, 1000]}))
    got = df.select(control_centre(F.col("t"), 10, 0, 1000, 5).alias("c")).toPandas().c.tolist()
    assert got[0] == 55 and got[1] == 50 and got[2] == 950
    capped = df.select(control_centre(F.col("t"), 10, 0, 60, 5).alias("c")).toPandas().c
    assert capped.isna().tolist() == [False, False, True]      # beyond the last tick: no control


def test_did_and_rollups_shapes(spark):
    rng = np.random.default_rng(2)
    n = 3000
    ts = np.sort(rng.choice(200_000, n, replace=False))
    series = pd.DataFrame({"rid": np.arange(n), "t": ts, "lat": rng.normal(100, 5, n)})
    ev = series.sample(90, random_state=1)
    ev = pd.DataFrame({"eid": ev.rid.to_numpy(), "tc": ev.t.to_numpy(),
                       "action": np.array(["A", "B", "C"])[np.arange(90) % 3],
                       "attack": np.array(["x", "y"])[np.arange(90) % 2],
                       "sev": np.array(["Low", "High"])[np.arange(90) % 2]})
    s = spark.createDataFrame(series)
    d = K.did_deltas(s, spark.createDataFrame(ev), t_col="t", tie_col="rid", value_col="lat", event_key="eid",
                     event_t="tc", group_col="action", half_width=3_000)
    eff = K.did_effects(d, event_key="eid", group_col="action", n_boot=200).toPandas()
    assert set(eff.action_type) <= {"A", "B", "C"} and (eff.ci_lower <= eff.ci_upper).all()
    assert ((eff.p_value >= 0) & (eff.p_value <= 1)).all()
    pp = K.pre_post(s, spark.createDataFrame(ev), t_col="t", tie_col="rid", value_col="lat", event_key="eid",
                    event_t="tc", half_width=3_000, attrs=["action", "attack", "sev"])
    r = K.rollups(pp, event_key="eid", action="action", attack="attack", severity="sev")
    best = r["best_by_attack"].toPandas()
    ba = r["by_attack"].toPandas()
    for _, row in best.iterrows():
        sub = ba[ba.attack == row.attack]
        assert row.recommended_action == sub.sort_values(["delta_mean", "action"]).action.iloc[0]


def test_window_moments_equal_materialised_windows(spark):
    from pyspark.sql import functions as F
    from tickwise.operators.rangejoin import event_windows, window_moments
    rng = np.random.default_rng(21)
    n = 1200
    ts = np.sort(rng.integers(0, 40_000, n))            # duplicate ticks
    series = spark.createDataFrame(pd.DataFrame({"rid": np.arange(n), "t": ts, "lat": rng.normal(50, 9, n)}))
    cen = pd.DataFrame({"eid": np.arange(80), "tc": rng.integers(-500, 40_500, 80)})   # incl. outside the data
    ev = spark.createDataFrame(cen)
    m = window_moments(series, ev, t_col="t", tie_col="rid", value_col="lat", centre_keys=["eid"],
                       centre_col="tc", half_width=900).toPandas().set_index("eid")
    w = event_windows(series, ev, t_col="t", tie_col="rid", value_cols=["lat"], event_keys=["eid"],
                      centre_col="tc", half_width=900)
    g = w.groupBy("eid").agg(F.sum(F.when(F.col("role") == "pre", 1).otherwise(0)).alias("pre_n"),
                             F.sum(F.when(F.col("role") == "pre", F.col("lat"))).alias("pre_sum"),
                             F.sum(F.when(F.col("role") == "post", 1).otherwise(0)).alias("post_n"),
                             F.sum(F.when(F.col("role") == "post", F.col("lat"))).alias("post_sum")).toPandas()
    g = g.set_index("eid").reindex(m.index)
    np.testing.assert_array_equal(m.pre_n.to_numpy(), g.pre_n.fillna(0).to_numpy())
    np.testing.assert_array_equal(m.post_n.to_numpy(), g.post_n.fillna(0).to_numpy())
    np.testing.assert_allclose(m.pre_sum.to_numpy(), g.pre_sum.fillna(0).to_numpy(), atol=1e-9)
    np.testing.assert_allclose(m.post_sum.to_numpy(), g.post_sum.fillna(0).to_numpy(), atol=1e-9)


def test_dense_spans_take_the_row_join_and_agree(spark):
    """One span holds most rows; beyond the bound its events go row by row."""
    rng = np.random.default_rng(4)
    ts = np.sort(np.concatenate([rng.integers(0, 50_000, 300), rng.integers(20_000, 20_900, 900)]))
    series = pd.DataFrame({"rid": np.arange(len(ts)), "t": ts, "lat": rng.normal(100, 10, len(ts))})
    events = pd.DataFrame({"eid": np.arange(0, len(ts), 9), "tc": ts[::9]})
    run = lambda **how: K.pre_post(spark.createDataFrame(series), spark.createDataFrame(events), t_col="t", tie_col="rid",
                                   value_col="lat", event_key="eid", event_t="tc", half_width=1_000, **how).toPandas().sort_values("eid", ignore_index=True)
    whole, split = run(), run(span_rows=400)
    assert len(whole) > 50
    pd.testing.assert_frame_equal(whole, split[whole.columns], check_dtype=False, rtol=1e-12)
    exp = _loop(ts, series.lat.to_numpy(), list(zip(events.eid, events.tc)), 1_000)
    assert set(whole.eid) == set(exp)


def test_missing_values_are_left_out_of_windows(spark):
    rows = [(i, i * 10, None if i % 4 == 0 else float("nan") if i % 7 == 0 else float(i)) for i in range(40)]
    series = spark.createDataFrame(rows, "rid long, t long, lat double")
    got = K.pre_post(series, spark.createDataFrame([(1, 200)], "eid long, tc long"), t_col="t", tie_col="rid", value_col="lat",
                     event_key="eid", event_t="tc", half_width=100).first()
    pre = [v for _, t, v in rows if 100 <= t < 200 and v is not None and v == v]
    post = [v for _, t, v in rows if 200 < t <= 300 and v is not None and v == v]
    assert (got.pre_n, got.post_n) == (10, 10)
    np.testing.assert_allclose([got.pre_mean, got.post_mean, got.pre_p95, got.post_p95],
                               [np.mean(pre), np.mean(post), np.percentile(pre, 95), np.percentile(post, 95)])
    empty = K.pre_post(series.limit(0), spark.createDataFrame([(1, 200)], "eid long, tc long"), t_col="t", tie_col="rid", value_col="lat",
                       event_key="eid", event_t="tc", half_width=100)
    assert empty.count() == 0
