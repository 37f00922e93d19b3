"""Streaming queries: the events table read as a file stream and run to
completion with the availableNow trigger (X1-X5).

Append-mode windows/sessions are emitted once the final watermark
(max event time - delay) has passed their end, so the oracle keeps exactly
those windows.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ..operators import models as M
from ..sources.tables import Tables
from ..streaming import stateful as S
from ..streaming import stream as X
from .registry import register, round_doubles

H = 3_600_000_000
DELAY_H = 2


def _events_stream(spark, sf_dir):
    return X.event_time(X.table_stream(spark, sf_dir, "events"))


@register("X2_streaming_tumbling_hourly_counts", f"""
WITH e AS (SELECT (epoch_us(ts) // {H}) * {H} AS window_start, epoch_us(ts) AS t, event_type, value FROM events),
wm AS (SELECT max(t) - {DELAY_H * H} AS wm FROM e)
SELECT window_start, window_start + {H} AS window_end, event_type, count(*) AS n, round(avg(value), 8) AS mean_value
FROM e GROUP BY window_start, event_type HAVING window_start + {H} <= (SELECT wm FROM wm)
""")
def x2(spark, sf_dir):
    s = X.tumbling_counts(_events_stream(spark, sf_dir), "event_time", "event_type", "1 hour",
                          f"{DELAY_H} hours", value="value")
    return round_doubles(X.run_available(s, "append", "x2"))


@register("X3_streaming_sliding_windows", f"""
WITH e AS (SELECT epoch_us(ts) AS t, value FROM events),
wm AS (SELECT max(t) - {DELAY_H * H} AS wm FROM e),
w AS (SELECT ((t // {H}) - k) * {H} AS window_start, value FROM e, range(3) r(k))
SELECT window_start, window_start + {3 * H} AS window_end, round(avg(value), 8) AS mean_value,
       round(stddev_samp(value), 8) AS std_value, count(value) AS n
FROM w GROUP BY window_start HAVING window_start + {3 * H} <= (SELECT wm FROM wm)
""")
def x3(spark, sf_dir):
    s = X.sliding_stats(_events_stream(spark, sf_dir), "event_time", "value", "3 hours", "1 hour",
                        f"{DELAY_H} hours")
    return round_doubles(X.run_available(s, "append", "x3"))


@register("X5_streaming_session_windows", f"""
WITH e AS (SELECT user_id, epoch_us(ts) AS t FROM events),
wm AS (SELECT max(t) - {DELAY_H * H} AS wm FROM e),
g AS (SELECT user_id, t, CASE WHEN lag(t) OVER (PARTITION BY user_id ORDER BY t) IS NULL
                              OR t - lag(t) OVER (PARTITION BY user_id ORDER BY t) >= {H} THEN 1 ELSE 0 END AS new_s
      FROM e),
s AS (SELECT user_id, t, sum(new_s) OVER (PARTITION BY user_id ORDER BY t) AS sid FROM g)
SELECT user_id, min(t) AS session_start, max(t) + {H} AS session_end, count(*) AS n
FROM s GROUP BY user_id, sid HAVING max(t) + {H} <= (SELECT wm FROM wm)
""")
def x5(spark, sf_dir):
    s = X.session_counts(_events_stream(spark, sf_dir), "event_time", "user_id", "1 hour", f"{DELAY_H} hours")
    return X.run_available(s, "append", "x5")


@register("X5_streaming_dedupe_within_watermark", """
SELECT DISTINCT user_id FROM events
""")
def x5d(spark, sf_dir):
    s = X.dedupe_stream(_events_stream(spark, sf_dir), "user_id", "event_time", f"{DELAY_H} hours")
    return X.run_available(s.select("user_id"), "append", "x5d")


@register("X4_streaming_asof_enrichment", f"""
WITH l AS (SELECT event_id, user_id, epoch_us(ts) AS t_us FROM events WHERE event_type <> 'error'),
r AS (SELECT event_id AS err_id, user_id, epoch_us(ts) AS match_t_us FROM events WHERE event_type = 'error')
SELECT l.event_id, l.user_id, l.t_us, r.match_t_us, r.err_id
FROM l LEFT JOIN r ON r.user_id = l.user_id AND abs(r.match_t_us - l.t_us) <= {6 * H}
QUALIFY row_number() OVER (PARTITION BY l.event_id ORDER BY abs(r.match_t_us - l.t_us), r.match_t_us, r.err_id) = 1
""")
def x4(spark, sf_dir):
    """Every non-error event with the nearest error of the same user within 6 h,
    answered once from keyed state; the end-of-stream mark drains the last ones."""
    def build(marks):
        ev = S.with_end_mark(_events_stream(spark, sf_dir), "event_time", marks)
        # the mark has no type or user: it goes with the left rows
        left = ev.where((F.col("event_type") != "error") | F.col("event_type").isNull())
        right = ev.where(F.col("event_type") == "error").select(
            F.col("event_id").alias("err_id"), "user_id", F.col("event_time").alias("err_time"))
        return S.asof_rows_stream(left, right, key="user_id", left_time="event_time", left_id="event_id", right_time="err_time",
                                  right_id="err_id", tolerance=6 * H, delay=f"{DELAY_H} hours")
    return S.run_drained(spark, build, "event_time", "x4")[0]


def _rolling_stream(spark, sf_dir, marks=None, **how):
    ev = _events_stream(spark, sf_dir)
    ev = S.with_end_mark(ev, "event_time", marks) if marks else ev
    return S.rolling_stats_stream(ev, id_col="event_id", time_col="event_time", value_col="value",
                                  windows={"1h": H, "6h": 6 * H}, delay=f"{DELAY_H} hours", **how)


def _rolling_sql(keys="", where=""):
    by = f"PARTITION BY {keys} " if keys else ""
    stats = ", ".join(f"""round(avg(value) OVER w{n}, 8) AS value_roll_mean_{n}h,
       round(coalesce(stddev_samp(value) OVER w{n}, 0), 8) AS value_roll_std_{n}h, CAST(count(value) OVER w{n} AS DOUBLE) AS rate_{n}h"""
                      for n in (1, 6))
    frames = ", ".join(f"w{n} AS ({by}ORDER BY t_us RANGE BETWEEN {n * H - 1} PRECEDING AND CURRENT ROW)" for n in (1, 6))
    return f"""
WITH e AS (SELECT event_id, user_id, epoch_us(ts) AS t_us, value FROM events),
r AS (SELECT {keys + ", " if keys else ""}event_id, t_us, round(value, 8) AS value, {stats} FROM e WINDOW {frames})
SELECT * FROM r{where}"""


# a row is settled when the watermark (milliseconds) has passed the one after its own
@register("X3_streaming_exact_rolling_rows",
          _rolling_sql(where=f" WHERE t_us // 1000 + 1 < (SELECT max(epoch_us(ts)) // 1000 FROM events) - {DELAY_H * 3_600_000}"))
def x3_rows(spark, sf_dir):
    """W1-W3 per row of a stream, for all rows before the final watermark."""
    S.stateful_session(spark)
    return round_doubles(X.run_available(_rolling_stream(spark, sf_dir), "append", "x3rows"))


@register("X3_streaming_exact_rolling_by_key_drained", _rolling_sql("user_id"))
def x3_by_key(spark, sf_dir):
    """The same per user, to the last row of the stream."""
    got, _ = S.run_drained(spark, lambda marks: _rolling_stream(spark, sf_dir, marks, keys=["user_id"], bucket_width=24 * 30 * H),
                           "event_time", "x3key")
    return round_doubles(got)


@register("X1_streaming_batch_scoring")
def x1(spark, sf_dir):
    """A ridge model fitted on the batch table scores the event stream."""
    ev = Tables(spark, sf_dir).events
    feats = ["user_id", "k"]

    def prep(df):
        return VectorAssembler(inputCols=feats, outputCol="features").transform(
            df.withColumn("k", F.get_json_object("props", "$.k").cast("double")))
    model = M.ridge(prep(ev), "features", "value")
    scored = model.transform(prep(X.table_stream(spark, sf_dir, "events"))).select("event_id", "prediction")
    return round_doubles(X.run_available(scored, "append", "x1"))
