"""Exact stratified / random samples and seeded noise."""

import numpy as np
import pandas as pd

from tickwise.operators.sample import inject_noise, random_sample, stratified_sample


def _pdf(n=5000, seed=0):
    rng = np.random.default_rng(seed)
    s = rng.choice(["a", "b", "c", None], n, p=[0.6, 0.25, 0.1, 0.05])
    return pd.DataFrame({"id": np.arange(n), "s": s, "x": rng.random(n)})


def test_exact_size_and_proportions(spark):
    pdf = _pdf()
    out = stratified_sample(spark.createDataFrame(pdf), 1000, 42, ["s", "missing_col"], "id",
                            prefix_len=2).toPandas()
    assert len(out) == 1000 and out.id.is_unique
    counts = pdf.s.fillna("<null>").value_counts()
    exp = (counts / len(pdf) * 1000).round().astype(int)
    exp[exp.idxmax()] += 1000 - exp.sum()
    got = out.s.fillna("<null>").value_counts()
    for k in exp.index:
        assert got.get(k, 0) == min(exp[k], counts[k])


def test_same_sample_whatever_partitioning(spark):
    pdf = _pdf(3000, 1)
    a = stratified_sample(spark.createDataFrame(pdf).repartition(3), 500, 7, ["s"], "id").toPandas()
    b = stratified_sample(spark.createDataFrame(pdf).repartition(11), 500, 7, ["s"], "id").toPandas()
    assert set(a.id) == set(b.id)
    c = stratified_sample(spark.createDataFrame(pdf), 500, 8, ["s"], "id").toPandas()
    assert set(a.id) != set(c.id)


def test_sample_is_smallest_hashes(spark):
    import hashlib
    pdf = _pdf(800, 2)
    got = random_sample(spark.createDataFrame(pdf), 100, 42, "id", prefix_len=1).toPandas()
    h = sorted(((hashlib.md5(f"42{i}".encode()).hexdigest(), i) for i in pdf.id))
    assert set(got.id) == {i for _, i in h[:100]}
    assert len(random_sample(spark.createDataFrame(pdf), 5000, 42, "id").toPandas()) == 800


def test_noise_scale_and_determinism(spark):
    pdf = pd.DataFrame({"id": np.arange(20000), "x": np.random.default_rng(0).normal(0, 2, 20000)})
    df = spark.createDataFrame(pdf)
    a = inject_noise(df, "x", 0.5, 3, "id").toPandas().sort_values("id")
    b = inject_noise(df.repartition(5), "x", 0.5, 3, "id").toPandas().sort_values("id")
    np.testing.assert_allclose(a.x.to_numpy(), b.x.to_numpy())
    noise = a.x.to_numpy() - pdf.x.to_numpy()
    assert abs(noise.std() - 0.5 * pdf.x.std()) < 0.05 and abs(noise.mean()) < 0.05
    z = inject_noise(df, "x", 0.0, 3, "id").toPandas().sort_values("id")
    np.testing.assert_allclose(z.x.to_numpy(), pdf.x.to_numpy())
