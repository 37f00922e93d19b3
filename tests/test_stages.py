"""Encoder and stacking in one pipeline: fitted, saved, loaded, equal scores."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import functions as F

from conftest import SF
from tickwise.operators.encode import fit_encoder
from tickwise.operators.features import RollingLagFeatures
from tickwise.operators.models import stacking
from tickwise.operators.stages import Stacking, TabularEncoder, TabularEncoderStage
from tickwise.session import micros

HOUR = 3_600_000_000


def raw_rows(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ev = ev.select("event_id", "user_id", "event_type", micros("ts").alias("t_us"), "value", (F.col("value") > 50).cast("double").alias("y_cls"))
    lo, hi = ev.agg(F.min("t_us"), F.max("t_us")).first()
    return ev.withColumn("held_out", F.col("t_us") > lo + (hi - lo) * 0.7)


def stages(bases, label, classification):
    roll = RollingLagFeatures(t_col="t_us", value_col="value", windows={"1h": HOUR, "1d": 24 * HOUR}, lags=[1, 2], tie_col="event_id")
    enc = TabularEncoder(numeric=roll.feature_names(), onehot=["event_type"], frequency=["user_id"])
    return [roll, enc, Stacking(bases, label, "held_out", classification)]


@pytest.mark.parametrize("classification", [False, True])
def test_pipeline_from_raw_rows_to_scores_survives_saving(spark, tmp_dir, classification):
    rows = raw_rows(spark).cache()
    if classification:
        bases = [LogisticRegression(labelCol="y_cls", maxIter=20), GBTClassifier(labelCol="y_cls", maxIter=3, maxDepth=2, seed=1)]
    else:
        bases = [LinearRegression(labelCol="value", regParam=0.1), GBTRegressor(labelCol="value", maxIter=3, maxDepth=2, seed=1)]
    model = Pipeline(stages=stages(bases, "y_cls" if classification else "value", classification)).fit(rows)
    model.write().overwrite().save(f"{tmp_dir}/pipeline")
    loaded = PipelineModel.load(f"{tmp_dir}/pipeline")
    scores = lambda m: {r.event_id: (r.prediction, *r.meta_features) for r in m.transform(rows).select("event_id", "prediction", "meta_features").collect()}
    first, again = scores(model), scores(loaded)
    assert len(first) == rows.count() and first == again
    assert len({s[0] for s in first.values()}) > 1
    # the same as the parts put together by hand
    x = model.stages[0].transform(rows)
    enc = fit_encoder(x, model.stages[1].spec())
    data = enc.transform(x, keep=["event_id", "value", "y_cls", "held_out"], assemble="features").cache()
    learn, held = data.where("not held_out"), data.where("held_out")
    fitted = [b.fit(learn) for b in bases]
    _, score = stacking(learn, held, "features", "y_cls" if classification else "value", fitted, classification=classification)
    by_hand = {r.event_id: r.prediction for r in score(data).select("event_id", "prediction").collect()}
    ids = sorted(first)
    np.testing.assert_allclose([first[i][0] for i in ids], [by_hand[i] for i in ids], rtol=1e-6, atol=1e-9)


def test_encoder_stage_keeps_columns_and_unseen_values(spark, tmp_dir):
    train = spark.createDataFrame([(1, 1.0, "a", "u"), (2, None, "b", "u"), (3, 3.0, None, "v")], "id int, x double, c string, k string")
    stage = TabularEncoder(numeric=["x"], onehot=["c"], ordinal={"c": ["a", "b"]}, frequency=["k"]).fit(train)
    stage.write().overwrite().save(f"{tmp_dir}/enc")
    loaded = TabularEncoderStage.load(f"{tmp_dir}/enc")
    new = spark.createDataFrame([(9, float("nan"), "zzz", "w"), (10, 2.0, "a", None)], train.schema)
    a, b = ([(r.id, r.c, r.k, r.features) for r in s.transform(new).orderBy("id").collect()] for s in (stage, loaded))
    assert a == b and stage.transform(new).columns == ["id", "x", "c", "k", "features"]
    assert a[0][3].toArray()[-1] == 0.0 and loaded.uid == stage.uid


def counted_rows(spark, rows):
    """``rows`` behind a Python step, and how many of them it has made so far."""
    made = spark.sparkContext.accumulator(0)

    def make(batches):
        for b in batches:
            made.add(len(b))
            yield b
    return rows.mapInPandas(make, rows.schema), made


def test_fits_make_their_rows_once(spark):
    rows = spark.range(300).selectExpr("id", "cast(id % 7 as double) x", "cast(id % 5 as double) z", "concat('u', id % 4) c",
                                       "cast(id as double) y", "id % 3 = 0 held_out")
    made_rows, made = counted_rows(spark, rows)
    stage = TabularEncoder(numeric=["x", "z"], onehot=["c"], frequency=["c"]).fit(made_rows)
    assert made.value == 300
    assert stage.transform(made_rows).count() == 300 and made.value <= 600  # the frequency map is written, not counted again
    coded = stage.transform(rows).drop("features").selectExpr("*", "x + z as s")
    made_rows, made = counted_rows(spark, coded)
    made_rows = VectorAssembler(inputCols=["x", "z", "s"], outputCol="features").transform(made_rows)
    Stacking([LinearRegression(labelCol="y", regParam=0.1), GBTRegressor(labelCol="y", maxIter=2, maxDepth=2, seed=1)], "y", "held_out").fit(made_rows)
    assert made.value == 300


def test_rolling_statistics_reach_the_scores(spark, tmp_dir, monkeypatch):
    from tickwise.plans import q_features as Q
    # runs of alike values with gaps between them: the last hours say more than the last value
    spark.range(400).selectExpr("id as event_id", "id % 3 as user_id", "if(id % 2 = 0, 'error', 'view') as event_type",
                                "timestamp_micros((id * 7 + (id div 10) * 200) * 60000000) as ts",
                                "cast((id div 10) % 4 * 10 + id % 5 as double) as value").write.parquet(f"{tmp_dir}/events.parquet")
    scores = lambda: {r.event_id: r.prediction for r in Q.f7_pipeline(spark, tmp_dir).collect()}
    first = scores()
    monkeypatch.setattr(Q, "WINDOWS", {"2m": 120_000_000, "1h": HOUR, "3h": 3 * HOUR})
    other = scores()
    assert len(first) == len(other) == 400
    assert any(abs(first[i] - other[i]) > 1e-3 for i in first)
