"""The main feature chain (F10, F11, S12): prepared data -> rolling and lag
features -> encoder -> vector -> model, saved, read again and compared; and
small rows for options that other queries leave out."""

from __future__ import annotations

import os
import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import bool_to_double, lookup_default, prob_flag
from ..operators import causal as K
from ..operators import joins as J
from ..operators import models as M
from ..operators.encode import EncoderSpec, TabularEncoderModel, fit_encoder
from ..operators.features import RollingLagFeatures
from ..operators.order import ROW_IDX, split_bounds
from ..session import ensure_checkpoint_dir, micros
from ..sources.tables import Tables
from .q_causal import K1_SQL, pre_post_table
from .q_windows import WINDOWS
from .registry import register, round_doubles

LAGS = tuple(range(1, 11))


def prepare_dataset(events: DataFrame, target: str = "is_error") -> DataFrame:
    """cast flags to doubles, add the time features, name the target."""
    x = events.select("event_id", "user_id", "event_type", "value", micros("ts").alias("t_us"),
                      (F.col("event_type") == "error").alias(target))
    return RollingLagFeatures(t_col="t_us", value_col="value", windows=WINDOWS, lags=LAGS, tie_col="event_id").transform(bool_to_double(x))


def feature_spec() -> EncoderSpec:
    names = RollingLagFeatures(t_col="t_us", value_col="value", windows=WINDOWS, lags=LAGS, tie_col="event_id").feature_names()
    return EncoderSpec(numeric=["value", *names], onehot=["event_type"], frequency=["user_id"])


def build_pipeline(data: DataFrame, n_rows: int | None = None) -> tuple[TabularEncoderModel, DataFrame]:
    """the encoder fitted on the first ``n_rows`` by position (all rows if
    None, as the reference does) and the data as features."""
    train = data if n_rows is None else data.where(F.col(ROW_IDX) < n_rows)
    model = fit_encoder(train, feature_spec())
    return model, model.transform(data, keep=["event_id", ROW_IDX, "is_error", "t_us"], assemble="features")


def _chain_sql() -> str:
    lags = ",\n       ".join(f"coalesce(lag(value, {k}) OVER w, first_value(value) OVER w, 0.0) AS value_lag_{k}" for k in LAGS)
    frames = {lab: f"OVER (ORDER BY t_us RANGE BETWEEN {w - 1} PRECEDING AND CURRENT ROW)" for lab, w in WINDOWS.items()}
    rolls = ",\n       ".join(f"avg(value) {fr} AS value_roll_mean_{lab}, coalesce(stddev_samp(value) {fr}, 0.0) AS value_roll_std_{lab}, "
                             f"CAST(count(value) {fr} AS DOUBLE) AS rate_{lab}" for lab, fr in frames.items())
    num = feature_spec().numeric
    stats = ",\n".join(f"m{i} AS (SELECT quantile_cont({c}, 0.5) AS med FROM tr),\n"
                       f"s{i} AS (SELECT avg(coalesce({c}, med)) AS mu, stddev_pop(coalesce({c}, med)) AS sd FROM tr, m{i})"
                       for i, c in enumerate(num))
    cols = ",\n       ".join(f"round((coalesce(x.{c}, m{i}.med) - s{i}.mu) / CASE WHEN s{i}.sd > 0 THEN s{i}.sd ELSE 1 END, 6) AS num__{c}"
                             for i, c in enumerate(num))
    return f"""
WITH e AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) AS t_us FROM events),
x AS (SELECT event_id, user_id, event_type, value,
       row_number() OVER w - 1 AS row_idx, count(*) OVER () AS n,
       {rolls},
       {lags}
FROM e WINDOW w AS (ORDER BY t_us, event_id)),
tr AS (SELECT * FROM x WHERE row_idx < CAST(floor(n * 0.7) AS BIGINT)),
f AS (SELECT user_id, count(*) / sum(count(*)) OVER () AS share FROM tr GROUP BY 1),
{stats}
SELECT x.event_id, x.row_idx, CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_error,
       CASE WHEN event_type = 'purchase' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS onehot__event_type_purchase,
       round(coalesce(f.share, 0.0), 6) AS freq__user_id_freq,
       {cols}
FROM x LEFT JOIN f ON x.user_id = f.user_id, {", ".join(f"m{i}, s{i}" for i in range(len(num)))}"""


@register("F10_F11_feature_chain", _chain_sql())
def feature_chain(spark, sf_dir):
    """9 rolling and 10 lag columns, encoder fitted on the first 70 % by time,
    all rows encoded."""
    data = prepare_dataset(Tables(spark, sf_dir).events)
    n, _ = split_bounds(data.count())
    _, out = build_pipeline(data, n)
    num = [f"num__{c}" for c in feature_spec().numeric]
    return round_doubles(out.select("event_id", ROW_IDX, "is_error", "onehot__event_type_purchase", "freq__user_id_freq", *num), 6)


@register("S12_F11_M11_saved_pipeline_scores", """
SELECT event_id, TRUE AS same_prediction, TRUE AS same_features FROM events""")
def saved_scores(spark, sf_dir):
    """The chain fitted on all rows and saved; the reloaded encoder and model
    give every row the same features and prediction."""
    data = prepare_dataset(Tables(spark, sf_dir).events)
    encoder, encoded = build_pipeline(data)
    model = M.fit_pipeline([LinearRegression(featuresCol="features", labelCol="is_error", solver="normal", regParam=1e-3)], encoded)
    path = os.path.join(ensure_checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    encoder.save(os.path.join(path, "encoder"))
    M.save_pipeline(model, os.path.join(path, "model"))
    again = TabularEncoderModel.load(spark, os.path.join(path, "encoder")).transform(data, keep=["event_id"], assemble="features")
    score = lambda m, d, name: m.transform(d).select("event_id", vector_to_array("features").alias(f"x{name}"), F.col("prediction").alias(name))
    before, after = score(model, encoded, "p"), score(M.load_pipeline(os.path.join(path, "model")), again, "q")
    return before.join(after, "event_id").select("event_id", (F.col("p") == F.col("q")).alias("same_prediction"),
                                                 (F.col("xp") == F.col("xq")).alias("same_features"))


@register("K6_A17_best_action_per_severity", K1_SQL + """,
bs AS (SELECT action_type, severity_level, avg(delta_mean) AS delta_mean FROM k1
       WHERE severity_level IS NOT NULL GROUP BY action_type, severity_level)
SELECT severity_level, arg_min(action_type, (delta_mean, action_type)) AS recommended_action,
       round(arg_min(delta_mean, (delta_mean, action_type)), 8) AS delta_mean
FROM bs GROUP BY severity_level
""")
def best_by_severity(spark, sf_dir):
    r = K.rollups(pre_post_table(spark, sf_dir), event_key="event_id", action="action_type", attack="attack_type", severity="severity_level")
    return round_doubles(r["best_by_severity"])


@register("K5_A10_rollup_action_by_attack", K1_SQL + """
SELECT action_type, attack_type, count(event_id) AS n, round(avg(delta_mean), 8) AS delta_mean,
       round(avg(delta_p95), 8) AS delta_p95
FROM k1 GROUP BY action_type, attack_type
""")
def by_attack(spark, sf_dir):
    r = K.rollups(pre_post_table(spark, sf_dir), event_key="event_id", action="action_type", attack="attack_type", severity="severity_level")
    return round_doubles(r["by_attack"])


@register("J1_P2_P3_colliding_columns", """
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus AS status, o.o_totalprice AS amount,
       n.n_name AS name, 'order' AS kind, c.c_acctbal AS amount_cust
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def collisions(spark, sf_dir):
    """Left columns win (P2: ``kind``), or both stay under another name (P3:
    ``amount``), when both sides have a column of that name."""
    t = Tables(spark, sf_dir)
    orders = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("amount"),
                             F.lit("order").alias("kind"), F.lit(0).alias("spare_dup"))
    orders = J.drop_suffixed(orders)
    cust = t.customer.select("c_custkey", "c_nationkey", F.col("c_acctbal").alias("amount"), F.lit("customer").alias("kind"))
    joined = J.left_join_dimension(orders, J.rename_collisions(cust, ["amount"], "_cust"), "o_custkey", "c_custkey")
    nation = t.nation.select("n_nationkey", F.col("n_name").alias("name"), F.lit("nation").alias("kind"))
    return J.left_join_dimension(joined, nation, "c_nationkey", "n_nationkey").drop("c_nationkey")


@register("J2_P9_null_safe_keep_first", """
WITH e AS (SELECT event_id, CASE WHEN user_id % 10 = 0 THEN NULL ELSE user_id END AS k, value FROM events),
f AS (SELECT k, arg_min(value, event_id) AS first_value FROM e GROUP BY k)
SELECT e.event_id, e.k, f.first_value FROM e LEFT JOIN f ON e.k IS NOT DISTINCT FROM f.k
""")
def null_safe(spark, sf_dir):
    """Null keys meet null keys, and keep-first takes one row for them too."""
    e = Tables(spark, sf_dir).events.select("event_id", F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("k"), "value")
    other = e.select("k", F.col("event_id").alias("at"), F.col("value").alias("first_value"))
    return J.left_join_first(e.drop("value"), other, "k", ["at"], null_safe=True).drop("at")


@register("C9_both_boundary_rules", """
SELECT event_id, coalesce(round(value / 500, 2) >= 0.5, NULL) AS online_flag, round(value / 500, 2) > 0.5 AS sequence_flag FROM events
""")
def both_rules(spark, sf_dir):
    """A score of just 0.5 is flagged online and not in sequence evaluation."""
    e = Tables(spark, sf_dir).events.select("event_id", F.round(F.col("value") / 500, 2).alias("p"))
    return e.select("event_id", prob_flag("p").alias("online_flag"), prob_flag("p", inclusive=False).alias("sequence_flag"))


@register("C15_J9_lookups_with_default", """
SELECT event_id, CASE event_type WHEN 'error' THEN 3 WHEN 'purchase' THEN 2 ELSE 0 END AS weight,
       coalesce(c.c_mktsegment, 'none') AS segment
FROM events e LEFT JOIN customer c ON e.user_id * 7 = c.c_custkey
""")
def lookups(spark, sf_dir):
    """A fixed mapping as a CASE, a data-sized one as a size-checked join; what
    is in neither gets the default."""
    t = Tables(spark, sf_dir)
    e = t.events.select("event_id", lookup_default("event_type", {"error": 3, "purchase": 2}, 0).alias("weight"),
                        (F.col("user_id") * 7).alias("k"))
    return J.lookup(e, "k", t.customer, "c_custkey", "c_mktsegment", "segment", "none").drop("k")


@register("F7_M7_S12_one_pipeline_raw_to_scores")
def f7_pipeline(spark, sf_dir):
    """Raw events to scores in one Pipeline (rolling and lag features, encoder,
    stacking of ridge and boosted trees), fitted on the first 70 % of the time
    with its last fifth for the meta learner, saved, loaded and applied to all
    rows. The target is the measured value, so a row's windows leave out the
    row itself."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.regression import GBTRegressor, LinearRegression

    from ..operators.stages import Stacking, TabularEncoder
    ev = Tables(spark, sf_dir).events
    rows = ev.select("event_id", "user_id", "event_type", micros("ts").alias("t_us"), "value", F.col("value").alias("target"))
    lo, hi = rows.agg(F.min("t_us"), F.max("t_us")).first()
    at = lambda share: F.col("t_us") > lo + (hi - lo) * share
    rows = rows.withColumn("held_out", at(0.56))
    roll = RollingLagFeatures(t_col="t_us", value_col="value", windows=WINDOWS, lags=LAGS, tie_col="event_id", include_current=False)
    enc = TabularEncoder(numeric=roll.feature_names(), onehot=["event_type"], frequency=["user_id"])
    bases = [LinearRegression(labelCol="target", regParam=0.1), GBTRegressor(labelCol="target", maxIter=5, maxDepth=3, seed=42)]
    model = Pipeline(stages=[roll, enc, Stacking(bases, "target", "held_out")]).fit(rows.where(~at(0.7)))
    path = os.path.join(ensure_checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    model.write().save(path)
    return round_doubles(PipelineModel.load(path).transform(rows).select("event_id", "prediction"), 6)
