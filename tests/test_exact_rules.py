"""Rules whose results differ only on rare values: ticks that are no whole
microseconds, scores on bin edges, NaN features, ties of any type."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickwise.functions.expr import lenient_bool, ns_to_timestamp
from tickwise.operators.asof import asof_join
from tickwise.operators.encode import EncoderSpec, fit_encoder
from tickwise.operators.evaluate import calibration
from tickwise.operators.order import with_row_index
from tickwise.operators.stats import missing_summary


def test_ns_ticks_round_down_exactly(spark):
    base = 1_704_067_200_000_000_000
    ticks = [base + k * 1_234_567_891 + r for k in range(300) for r in (0, 1, 999)] + [-1, -1000, -1001, 0, 999]
    got = spark.createDataFrame([(t,) for t in ticks], "t long").select("t", F.unix_micros(ns_to_timestamp("t")).alias("u")).collect()
    assert all(r.u == r.t // 1000 for r in got)


def test_only_numbers_and_boolean_words_become_booleans(spark):
    rows = [("1", True), ("0.5", False), ("-2", True), ("true", True), ("FALSE", False), ("yes", None), ("t", None), ("", None), (None, None)]
    got = spark.createDataFrame([(s,) for s, _ in rows], "s string").select("s", lenient_bool("s").alias("b")).collect()
    assert [r.b for r in got] == [b for _, b in rows]


def test_calibration_bins_by_edges(spark):
    edges = np.linspace(0, 1, 11)
    scores = [float(x) for e in edges for x in (np.nextafter(e, -1), e, np.nextafter(e, 2)) if 0 <= x <= 1] + [0.7000000000000001]
    got = calibration(spark.createDataFrame([(s, 1) for s in scores], "p double, y int"), "y", "p").collect()
    want = np.bincount(np.searchsorted(edges[1:-1], scores), minlength=10)
    assert {r.bin: r.n for r in got} == {i: int(n) for i, n in enumerate(want) if n}


def test_encoder_takes_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,), (6.0,)], "x double")
    got = [r[0] for r in fit_encoder(df, EncoderSpec(numeric=["x"])).transform(df).collect()]
    v = np.array([1, 2, 2, 2, 6.0])
    assert np.allclose(sorted(got), sorted((v - v.mean()) / v.std()))


@pytest.mark.parametrize("takes", ["last", "first"])
@pytest.mark.parametrize("strategy", ["fixed", "depth"])
def test_ties_may_be_strings(spark, takes, strategy):
    left = spark.createDataFrame([(10, "k"), (25, "k")], "t long, k string")
    right = spark.createDataFrame([(9, "k", "b", 1), (9, "k", "a", 2), (9, "k", "c", 3), (24, "k", "z", 4)], "rt long, k string, tie string, v long")
    got = asof_join(left, right, on="t", right_on="rt", by="k", direction="backward", tolerance=5, right_tie="tie", backward_takes=takes,
                    strategy=strategy, target_rows=2).orderBy("t").collect()
    assert [r.v for r in got] == [3 if takes == "last" else 2, 4]


def test_most_missing_first(spark):
    df = spark.createDataFrame([(1, None, None, 1.0), (None, None, None, float("nan")), (3, None, 3, 1.0)], "a long, b long, c long, d double")
    assert [(r.position, r.column, r.missing) for r in missing_summary(df).orderBy("position").collect()] == [
        (0, "b", 3), (1, "c", 2), (2, "a", 1), (3, "d", 1)]


def test_row_index_runs_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(1000).repartition(3).mapInArrow(count, "id long")
    out, n = with_row_index(df, ["id"])
    assert n == 1000 and out.where("row_idx = id").count() == 1000 and seen.value == 1000


def test_quantiles_of_few_values(spark):
    """Values shared by many rows are added up first; positions are exact."""
    from tickwise.operators.stats import exact_quantiles
    rng = np.random.default_rng(4)
    v = np.concatenate([rng.integers(0, 3, 900), rng.normal(size=101) * 5]).astype(float)
    g = np.concatenate([np.zeros(900, int), np.ones(101, int)])
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, v)] + [(2, 7.0), (1, None), (0, float("nan"))], "g int, v double")
    qs = [0.0, 0.05, 0.25, 0.5, 0.95, 1.0]
    got = {r.g: list(r)[1:] for r in exact_quantiles(df, "v", qs, ["g"]).collect()}
    for k in (0, 1):
        assert np.allclose(got[k], np.quantile(v[g == k], qs))
    assert got[2] == [7.0] * 6
    assert np.allclose(list(exact_quantiles(df, "v", qs).first()), np.quantile(np.append(v, 7.0), qs))


def test_domains_beyond_the_limit_are_refused(spark):
    from tickwise.operators.stats import pivot_mean
    df = spark.range(50).selectExpr("id % 2 AS i", "id AS c", "1.0D AS v")
    with pytest.raises(ValueError, match="more than 20"):
        pivot_mean(df, "i", "c", "v", max_columns=20)
    assert len(pivot_mean(df, "i", "c", "v").columns) == 51
