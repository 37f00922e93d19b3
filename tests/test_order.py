"""Global index, splits, folds, slices, zip join, systematic sample."""

import numpy as np
import pandas as pd

from conftest import SF
from tickwise.operators.order import (chrono_split, cumulative_sums, expanding_folds, fold_bounds,
                                      linspace_positions, positional_slice, split_bounds,
                                      systematic_sample, with_row_index, zip_join)


def test_row_index_dense_and_ordered(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"id": np.arange(5000), "t": rng.integers(0, 100, 5000)})   # many ties on t
    df, n = with_row_index(spark.createDataFrame(pdf).repartition(7), ["t", "id"], num_partitions=6)
    got = df.toPandas().sort_values("row_idx")
    assert n == 5000 and list(got.row_idx) == list(range(5000))
    exp = pdf.sort_values(["t", "id"]).id.to_numpy()
    assert (got.id.to_numpy() == exp).all()


def test_keyed_row_index(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"id": np.arange(3000), "k": rng.choice([0, 0, 0, 1, 2], 3000), "t": rng.random(3000)})
    df, _ = with_row_index(spark.createDataFrame(pdf), ["t", "id"], partition_by=["k"], num_partitions=5)
    got = df.toPandas()
    exp = pdf.sort_values(["k", "t", "id"]).assign(e=lambda x: x.groupby("k").cumcount())
    m = got.merge(exp[["id", "e"]], on="id")
    assert (m.row_idx == m.e).all()


def test_split_invariants(spark):
    pdf = pd.DataFrame({"id": np.arange(1001), "t": np.arange(1001) // 3})
    s = chrono_split(spark.createDataFrame(pdf), ["t", "id"]).toPandas()
    a, b = split_bounds(1001)
    assert (a, b) == (700, 850)
    tr, va, te = (s[s.split == x] for x in ("train", "val", "test"))
    assert (len(tr), len(va), len(te)) == (700, 150, 151)
    assert tr.t.max() <= va.t.min() and va.t.max() <= te.t.min()


def test_folds_expanding_and_disjoint(spark):
    assert fold_bounds(100, 4) == [0, 20, 40, 60, 80, 100]
    pdf = pd.DataFrame({"id": np.arange(100), "t": np.arange(100)})
    f = expanding_folds(spark.createDataFrame(pdf), ["t"], 4).toPandas()
    for k in range(1, 5):
        tr = f[(f.fold == k) & (f.role == "train")].row_idx
        va = f[(f.fold == k) & (f.role == "val")].row_idx
        assert tr.max() < va.min() and len(tr) == 20 * k and len(va) == 20
    assert fold_bounds(3, 5) == [0, 0, 1, 2, 2, 2, 3]


def test_slice_and_zip_join(spark):
    pdf = pd.DataFrame({"id": np.arange(10), "t": np.arange(10)[::-1]})
    sl = positional_slice(spark.createDataFrame(pdf), ["t"], 2, 5).toPandas().sort_values("row_idx")
    assert list(sl.t) == [2, 3, 4]
    neg = positional_slice(spark.createDataFrame(pdf), ["t"], -3, None).toPandas()
    assert sorted(neg.t) == [7, 8, 9]
    other = pd.DataFrame({"id": np.arange(4), "x": [10, 11, 12, 13]})
    z = zip_join(spark.createDataFrame(pdf), ["t"], spark.createDataFrame(other), ["id"]).toPandas()
    z = z.sort_values("row_idx")
    assert len(z) == 10 and list(z.x.iloc[:4]) == [10, 11, 12, 13] and z.x.iloc[4:].isna().all()
    assert "id_stab" in z.columns      # collision renamed


def test_linspace_positions_and_sample(spark):
    for n in (1, 7, 499, 500, 10_000, 12_345):
        exact = linspace_positions(n, 500)
        ref = np.linspace(0, n - 1, 500, dtype=int)
        assert max(abs(a - b) for a, b in zip(exact, ref)) <= 1
    pdf = pd.DataFrame({"id": np.arange(2000), "t": np.arange(2000)})
    s = systematic_sample(spark.createDataFrame(pdf), ["t"], 500).toPandas()
    assert len(s) == 500 and s.row_idx.min() == 0 and s.row_idx.max() == 1999


def test_cumulative_sums(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 800), "o": rng.permutation(800), "x": rng.integers(0, 9, 800)})
    got = cumulative_sums(spark.createDataFrame(pdf), ["o"], ["x"], partition_by=["g"], num_partitions=5).toPandas()
    exp = pdf.sort_values(["g", "o"]).assign(e=lambda d: d.groupby("g").x.cumsum())
    m = got.merge(exp[["o", "e"]], on="o")
    assert (m.x_cum == m.e).all()


def test_scans_are_not_written_before_their_bounds_are_sampled(spark):
    from pyspark.sql import functions as F
    from tickwise.session import scan_only
    rows = spark.read.parquet(f"{SF}/events.parquet")
    assert scan_only(rows) and scan_only(rows.where("value > 3").select("event_id", F.col("value") + 1))
    assert not scan_only(rows.groupBy("user_id").count()) and not scan_only(rows.join(rows.select("user_id"), "user_id"))
    assert not scan_only(rows.distinct()) and not scan_only(rows.orderBy("value"))
