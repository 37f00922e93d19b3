"""Source/sink round trips over driver data.

Each query writes a table derived from the driver tables into a fresh folder
under the checkpoint directory with the library's writer and reads it back
with the library's reader, so the result checks both directions.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..functions.expr import coerce_boolean, coerce_numeric
from ..operators import stats as S
from ..session import ensure_checkpoint_dir
from ..sources import io
from ..sources.tables import Tables
from .registry import register, round_doubles


def _scratch(spark, label):
    return os.path.join(ensure_checkpoint_dir(spark), f"{label}-{uuid.uuid4().hex}")


@register("S6_S1_S2_csv_parquet_roundtrip_coercion", """
SELECT event_id, epoch_us(ts) * 1000 AS ts, user_id, event_type, value,
       CAST(json_extract_string(props, '$.k') AS INTEGER) % 2 <> 0 AS success_flag
FROM events
""")
def s6(spark, sf_dir):
    """events -> save_table (Parquet + CSV, ns ticks) -> CSV scan as strings
    -> lenient numeric / boolean coercion (C2, C3)."""
    ev = Tables(spark, sf_dir).events.select(
        "event_id", "ts", "user_id", "event_type", "value",
        (F.get_json_object("props", "$.k").cast("int") % 2).cast("string").alias("success_flag"))
    paths = io.save_table(ev, _scratch(spark, "s6"), "Combined")
    back = io.read_csv(spark, paths["csv"])
    back = coerce_boolean(coerce_numeric(back, ["value"]), ["success_flag"])
    return back.select(F.col("event_id").cast("long"), F.col("ts").cast("long"), F.col("user_id").cast("long"),
                       "event_type", "value", "success_flag")


@register("S8_S9_predictions_json_lines_roundtrip", """
SELECT event_id, round(value / 10, 4) AS predicted, value / 10 >= 5.0 AS violation_flag
FROM events
""")
def s8(spark, sf_dir):
    """predictions of all events -> JSON lines sink (one object per row,
    written by every task) -> JSON scan with the declared schema."""
    ev = Tables(spark, sf_dir).events
    pred = ev.select("event_id", F.round(F.col("value") / 10, 4).alias("predicted"),
                     (F.col("value") / 10 >= 5.0).alias("violation_flag"))
    path = io.write_predictions(pred, _scratch(spark, "s8"))
    return spark.read.schema(pred.schema).json(path)


@register("S11_A2_profile_sink_roundtrip", """
SELECT 'events' AS "table", count(*) AS n_rows, 6 AS n_columns, c AS "column",
       count(*) - count(v) AS missing
FROM (SELECT unnest(['event_id', 'ts', 'user_id', 'event_type', 'value', 'props']) AS c,
             unnest([CAST(event_id AS VARCHAR), CAST(ts AS VARCHAR), CAST(user_id AS VARCHAR), event_type,
                     CAST(value AS VARCHAR), props]) AS v FROM events)
GROUP BY c
""")
def s11(spark, sf_dir):
    prof = S.profile(Tables(spark, sf_dir).events, "events")
    path = _scratch(spark, "s11")
    io.write_metrics(prof, path, "json")
    back = spark.read.schema(prof.schema).json(path)
    return back.select("table", "n_rows", "n_columns", "column", "missing")


@register("S7_F9_feature_table_sink_roundtrip", """
WITH e AS (SELECT event_id, value, epoch_us(ts) AS t_us FROM events)
SELECT event_id, value, t_us, round(avg(value) OVER (ORDER BY t_us RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW), 8) AS value_roll_mean_1h, round(coalesce(stddev_samp(value) OVER (ORDER BY t_us RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW), 0.0), 8) AS value_roll_std_1h, CAST(count(value) OVER (ORDER BY t_us RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW) AS DOUBLE) AS rate_1h, round(avg(value) OVER (ORDER BY t_us RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW), 8) AS value_roll_mean_24h, round(coalesce(stddev_samp(value) OVER (ORDER BY t_us RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW), 0.0), 8) AS value_roll_std_24h, CAST(count(value) OVER (ORDER BY t_us RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW) AS DOUBLE) AS rate_24h, coalesce(lag(value, 1) OVER w, first_value(value) OVER w, 0.0) AS value_lag_1, coalesce(lag(value, 2) OVER w, first_value(value) OVER w, 0.0) AS value_lag_2, row_number() OVER w - 1 AS row_idx
FROM e WINDOW w AS (ORDER BY t_us, event_id)
""")
def s7(spark, sf_dir):
    """Rolling + lag features written range-partitioned by time (one time slice
    per file) and read back."""
    from ..operators.features import RollingLagFeatures
    from ..session import micros
    ev = Tables(spark, sf_dir).events.select("event_id", "value", micros("ts").alias("t_us"))
    h = 3_600_000_000
    feats = RollingLagFeatures(t_col="t_us", value_col="value", windows={"1h": h, "24h": 24 * h},
                               lags=(1, 2), tie_col="event_id").transform(ev)
    path = io.save_feature_table(round_doubles(feats), _scratch(spark, "s7"), "t_us")
    return spark.read.parquet(path)


@register("S10_K2_effect_summary_csv_roundtrip")
def s10(spark, sf_dir):
    """DiD effect rows written as CSV with a header and read back with the
    declared schema."""
    from .q_causal import k2
    eff = k2(spark, sf_dir)
    path = io.write_metrics(eff, _scratch(spark, "s10"), "csv")
    return spark.read.schema(eff.schema).option("header", True).csv(path)
