"""Exact per-row streams: several micro-batches, late rows, ties and the drain."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickwise.functions.moments import mean_std, rolling_moments
from tickwise.streaming import stateful as S

MINUTE = 60_000_000
SCHEMA = "event_id long, k long, event_time timestamp, value double"


def write_batches(spark, folder, batches):
    """One file per batch, in the order of their names and times."""
    import os
    import time
    for i, rows in enumerate(batches):
        part = f"{folder}/in-{i}"
        spark.createDataFrame(rows, "event_id long, k long, t long, value double").select(
            "event_id", "k", F.timestamp_micros("t").alias("event_time"), "value").coalesce(1).write.parquet(part)
        name = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        os.makedirs(f"{folder}/events", exist_ok=True)
        os.rename(f"{part}/{name}", f"{folder}/events/b{i}.parquet")
        os.utime(f"{folder}/events/b{i}.parquet", (time.time() - 1000 + i, time.time() - 1000 + i))


def stream_of(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/events")


def rows_of(rng, n, start, span, first_id):
    t = np.sort(rng.integers(start, start + span, n)) // 1000 * 1000
    t[1::9] = t[0::9][:len(t[1::9])]  # equal ticks
    return [(first_id + i, int(rng.integers(0, 3)), int(x), None if i % 11 == 0 else float(rng.normal())) for i, x in enumerate(np.sort(t))]


@pytest.mark.parametrize("keys,include,ties", [([], True, False), (["k"], False, True)])
def test_rolling_rows_equal_a_loop_over_batches(spark, tmp_dir, keys, include, ties):
    rng = np.random.default_rng(1)
    batches = [rows_of(rng, 60, i * 40 * MINUTE, 40 * MINUTE, i * 100) for i in range(3)]
    late = (999, 0, 5 * MINUTE, 1e9)   # far behind the watermark of the second batch
    write_batches(spark, tmp_dir, [*batches[:2], batches[2] + [late]])

    def build(marks):
        return S.rolling_stats_stream(S.with_end_mark(stream_of(spark, tmp_dir), "event_time", marks), id_col="event_id", time_col="event_time",
                                      value_col="value", windows={"w": 15 * MINUTE}, delay="1 minute", keys=keys, include_current=include, exact_ties=ties)
    got, dropped = S.run_drained(spark, build, "event_time")
    got = {r.event_id: r for r in got.collect()}
    rows = pd.DataFrame([r for b in batches for r in b], columns=["id", "k", "t", "v"]).sort_values(["t", "id"])
    assert set(got) == set(rows.id) and dropped >= 1
    for _, part in (rows.groupby("k") if keys else [(None, rows)]):
        t, v = part.t.to_numpy(), part.v.to_numpy(dtype=float)
        m = rolling_moments(t, v, 15 * MINUTE, include, ties)
        mean, std = mean_std(m)
        for i, a, b, n in zip(part.id, mean, std, m[0]):
            r = got[i]
            assert (r.value_roll_mean_w is None or np.isnan(r.value_roll_mean_w)) if n == 0 else r.value_roll_mean_w == pytest.approx(a, rel=1e-12)
            assert r.value_roll_std_w == pytest.approx(b, abs=1e-12) and r.rate_w == n


def test_asof_rows_answer_every_left_row_once(spark, tmp_dir):
    rng = np.random.default_rng(7)
    batches = [rows_of(rng, 80, i * 30 * MINUTE, 30 * MINUTE, i * 100) for i in range(3)]
    write_batches(spark, tmp_dir, batches)

    def build(marks):
        ev = S.with_end_mark(stream_of(spark, tmp_dir), "event_time", marks)
        left = ev.where((F.col("event_id") % 3 != 0) | F.col("event_id").isNull())
        right = ev.where(F.col("event_id") % 3 == 0).select(F.col("event_id").alias("rid"), "k", F.col("event_time").alias("rt"))
        return S.asof_rows_stream(left, right, key="k", left_time="event_time", left_id="event_id", right_time="rt", right_id="rid",
                                  tolerance=2 * MINUTE, delay="1 minute")
    got, _ = S.run_drained(spark, build, "event_time")
    rows = [r for b in batches for r in b]
    want = {}
    for i, k, t, _ in rows:
        if i % 3:
            near = sorted((abs(u - t), u, j) for j, l, u, _ in rows if j % 3 == 0 and l == k and abs(u - t) <= 2 * MINUTE)
            want[i] = (near[0][2], near[0][1]) if near else (None, None)
    found = got.collect()
    assert len(found) == len(want)
    assert {r.event_id: (r.rid, r.match_t_us) for r in found} == want


def test_state_keeps_blocks_of_rows():
    pdf = pd.DataFrame({"s_t": [5, 3], "s_id": [1, 2], "s_v": [None, 2.5], "s_c": [False, True], "s_own": [True, False]})

    class State(list):
        def get(self):
            return iter(self)
    blocks = [S.as_block(pdf, S.ROLLING_BLOCK), S.as_block(pdf[:1], S.ROLLING_BLOCK)]
    got = S.held_block(State((b.tobytes(),) for b in blocks), S.ROLLING_BLOCK)
    assert got["t"].tolist() == [5, 3, 5] and got["own"].tolist() == [True, False, True]
    np.testing.assert_array_equal(got["v"], [np.nan, 2.5, np.nan])
    assert len(S.held_block(State(), S.NEAREST_BLOCK)) == 0
    with pytest.raises(ValueError):
        S.as_block(pdf.assign(s_id=[1, None]), S.NEAREST_BLOCK)
