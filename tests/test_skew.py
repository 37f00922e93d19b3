"""Skew: one key with a third of all rows, packed in a short time span."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tickwise.operators.asof import asof_join
from tickwise.operators.buckets import fit_depth_buckets
from tickwise.operators.sample import stratified_sample


def _hot(n=6000, seed=0):
    rng = np.random.default_rng(seed)
    k = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 200, n))
    t = np.where(k == 0, rng.integers(0, 50, n), rng.integers(0, 100_000, n))   # hot key: 50 ticks
    return pd.DataFrame({"id": np.arange(n), "k": k, "t": t})


def test_depth_buckets_split_a_hot_key(spark):
    df = spark.createDataFrame(_hot())
    b = fit_depth_buckets(df.select("t"), "t", target_rows=300)
    sizes = b.assign(df, "t", "b").groupBy("k", "b").count()
    worst = sizes.agg(F.max("count")).first()[0]
    hot_rows = df.where(F.col("k") == 0).count()
    # the hot key's 2000 rows are spread over many buckets; no group far above the target
    assert sizes.where(F.col("k") == 0).count() >= 5
    assert worst <= 300 * 1.5 and worst < hot_rows / 4


def test_stray_ticks_do_not_stretch_the_buckets(spark):
    """Two outliers, one far below and one far above: the rest is still cut evenly."""
    t = [-10**17, 10**18] + [1_700_000_000_000_000_000 + i for i in range(20_000)]
    df = spark.createDataFrame([(x,) for x in t], "t long")
    sizes = fit_depth_buckets(df, "t", target_rows=1000).assign(df, "t", "b").groupBy("b").count()
    assert sizes.agg(F.max("count")).first()[0] <= 2000 and sizes.count() >= 15


def test_asof_hot_key_matches_pandas(spark):
    pdf = _hot(3000, 1)
    left = pdf.iloc[::2].rename(columns={"id": "lid"})
    right = pdf.iloc[1::2].rename(columns={"id": "rid", "t": "rt", "k": "rk"}).drop_duplicates(["rt", "rk"])
    exp = pd.merge_asof(left.sort_values("t"), right.sort_values("rt"), left_on="t", right_on="rt",
                        left_by="k", right_by="rk", direction="nearest", tolerance=500).set_index("lid")["rid"]
    got = asof_join(spark.createDataFrame(left), spark.createDataFrame(right), on="t", right_on="rt", by="k",
                    right_by="rk", tolerance=500, right_tie="rid",
                    target_rows=100).toPandas().set_index("lid")["rid"].reindex(exp.index)
    assert ((exp.isna() & got.isna()) | (exp == got)).all()


def test_stratified_sample_hot_stratum_exact(spark):
    pdf = _hot(6000, 2).assign(s=lambda d: np.where(d.k == 0, "hot", "cold"))
    out = stratified_sample(spark.createDataFrame(pdf), 600, 42, ["s"], "id", prefix_len=2).toPandas()
    counts = pdf.s.value_counts()
    exp = (counts / len(pdf) * 600).round().astype(int)
    exp[exp.idxmax()] += 600 - exp.sum()
    assert out.s.value_counts().to_dict() == exp.to_dict()
