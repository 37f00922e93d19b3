"""Encoders: scikit-learn parity rules and the reference's pipeline invariants."""

import numpy as np
import pandas as pd

from tickwise.operators.encode import EncoderSpec, TabularEncoderModel, fit_encoder

ORD = {"severity_level": ["Low", "Medium", "High", "Critical"], "operational_state": ["Normal", "Degraded", "Fault"]}


def _frames():
    train = pd.DataFrame({
        "a": [1.0, 2.0, 3.0, 4.0, None], "const": [5.0] * 5, "allnull": [None] * 5,
        "mob": ["Static", "Mobile", "Static", None, "Mobile"],
        "two": ["x", "y", "x", "y", "x"],
        "severity_level": ["Low", None, "High", "Critical", "Medium"],
        "operational_state": ["Normal", "Fault", None, "Degraded", "Bogus"],
        "dev": [1, 1, 2, None, 3]})
    test = pd.DataFrame({
        "a": [None, 10.0], "const": [5.0, 6.0], "allnull": [None, 1.0], "mob": ["Flying", "Static"],
        "two": ["y", "z"], "severity_level": [None, "Unknown"], "operational_state": [None, "Fault"],
        "dev": [1, 99]})
    return train, test


def _spec():
    return EncoderSpec(numeric=["a", "const", "allnull"], onehot=["mob", "two"], ordinal=ORD, frequency=["dev"])


def test_parity_rules(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("const", T.DoubleType()),
                           T.StructField("allnull", T.DoubleType()), T.StructField("mob", T.StringType()),
                           T.StructField("two", T.StringType()), T.StructField("severity_level", T.StringType()),
                           T.StructField("operational_state", T.StringType()), T.StructField("dev", T.LongType())])
    tr, te = _frames()

    def rows(pdf):
        out = []
        for rec in pdf.to_dict("records"):
            r = [None if (isinstance(v, float) and np.isnan(v)) else v for v in rec.values()]
            r[-1] = None if r[-1] is None else int(r[-1])
            out.append(r)
        return out
    train = spark.createDataFrame(rows(tr), schema)
    test = spark.createDataFrame(rows(te), schema)
    m = fit_encoder(train, _spec())
    assert "allnull" not in m.medians                              # all-null column dropped
    assert m.medians["a"] == 2.5                                     # exact interpolated median
    imputed = np.array([1, 2, 3, 4, 2.5])
    assert np.isclose(m.scales["a"], imputed.std())                  # population std
    assert m.scales["const"] == 1.0                                  # zero variance -> 1
    names = m.feature_names()
    assert "onehot__two_y" in names and "onehot__two_x" not in names  # if-binary keeps the second
    assert {"onehot__mob_Mobile", "onehot__mob_Static", "onehot__mob___MISSING__"} <= set(names)
    out = m.transform(test, assemble="features").toPandas()
    assert len(out.columns) == len(names) + 1
    r0, r1 = out.iloc[0], out.iloc[1]
    assert np.isclose(r0["num__a"], (2.5 - imputed.mean()) / imputed.std())
    assert r0[[c for c in names if c.startswith("onehot__mob")]].sum() == 0     # unknown -> zeros
    assert r0["ordinal__severity_level"] == -1.0                    # null -> 'Normal' -> unknown for severity
    assert r0["ordinal__operational_state"] == 0.0                  # null -> 'Normal' -> 0
    assert r1["ordinal__severity_level"] == -1.0 and r1["ordinal__operational_state"] == 2.0
    assert np.isclose(r0["freq__dev_freq"], 2 / 4) and r1["freq__dev_freq"] == 0.0
    assert not out[names].isna().any().any()


def test_save_load_roundtrip(spark, tmp_dir):
    tr, te = _frames()
    train = spark.createDataFrame(tr[["a", "mob", "dev"]].fillna({"mob": "Static"}))
    m = fit_encoder(train, EncoderSpec(numeric=["a"], onehot=["mob"], frequency=["dev"]))
    m.save(tmp_dir)
    m2 = TabularEncoderModel.load(spark, tmp_dir)
    assert m2.feature_names() == m.feature_names() and m2.medians == m.medians
    a = m.transform(train).toPandas().sort_values("num__a").reset_index(drop=True)
    b = m2.transform(train).toPandas().sort_values("num__a").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b)
