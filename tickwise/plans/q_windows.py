"""Window queries on the events stream: rolling time windows, lags with
backfill, resampling, grouped bin counts, sliding sequences, context rows
(W1-W5, W7, W8/A12, W11-W13, F9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.order import with_row_index
from ..operators.window import (context_rows, grouped_bin_counts, lag_features, resample,
                                rolling_time_stats, sliding_sequences)
from ..session import micros
from ..sources.tables import Tables
from .registry import register, round_doubles

H = 3_600_000_000
WINDOWS = {"1h": H, "6h": 6 * H, "24h": 24 * H}
EV_ORDER = ["t_us", "event_id"]


def _events(spark, sf_dir):
    return Tables(spark, sf_dir).events.select("event_id", "user_id", "event_type", "value",
                                               micros("ts").alias("t_us"))


def _roll_sql_cols():
    out = []
    for lab, w in WINDOWS.items():
        fr = f"OVER (ORDER BY t_us RANGE BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
        out += [f"round(avg(value) {fr}, 8) AS value_roll_mean_{lab}",
                f"round(coalesce(stddev_samp(value) {fr}, 0.0), 8) AS value_roll_std_{lab}",
                f"CAST(count(value) {fr} AS DOUBLE) AS rate_{lab}"]
    return ",\n       ".join(out)


@register("W1_W2_W3_rolling_time_windows", f"""
SELECT event_id, t_us, value,
       {_roll_sql_cols()}
FROM (SELECT event_id, value, epoch_us(ts) AS t_us FROM events)
""")
def w1(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", "t_us", "value")
    return round_doubles(rolling_time_stats(ev, "t_us", "value", WINDOWS))


# ticks of ten minutes: many equal ones
COARSE = 600_000_000


def _coarse(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", (F.col("t_us") - F.pmod("t_us", F.lit(COARSE))).alias("t_us"), "value")


def _option_sql(seen: str) -> str:
    """Self-join over the window: ``seen`` says which rows of it row a sees."""
    stats = ", ".join(f"""round(avg(b.value) FILTER (WHERE b.t_us > a.t_us - {w}), 8) AS value_roll_mean_{lab},
       round(coalesce(stddev_samp(b.value) FILTER (WHERE b.t_us > a.t_us - {w}), 0.0), 8) AS value_roll_std_{lab},
       CAST(count(b.value) FILTER (WHERE b.t_us > a.t_us - {w}) AS DOUBLE) AS rate_{lab}""" for lab, w in WINDOWS.items())
    return f"""
WITH e AS (SELECT event_id, value, epoch_us(ts) // {COARSE} * {COARSE} AS t_us FROM events)
SELECT a.event_id, a.t_us, a.value, {stats}
FROM e a LEFT JOIN e b ON b.t_us BETWEEN a.t_us - {max(WINDOWS.values()) - 1} AND a.t_us AND {seen}
GROUP BY a.event_id, a.t_us, a.value"""


@register("W1_W2_W3_without_current_row", _option_sql("b.event_id <> a.event_id"))
def w1_without_current(spark, sf_dir):
    """Rolling features of a target that don't see the row's own value."""
    return round_doubles(rolling_time_stats(_coarse(spark, sf_dir), "t_us", "value", WINDOWS, include_current=False))


@register("W1_W2_W3_exact_ties", _option_sql("(b.t_us < a.t_us OR b.event_id <= a.event_id)"))
def w1_exact_ties(spark, sf_dir):
    """Rows of one tick see those before them only, in the order of their ids."""
    return round_doubles(rolling_time_stats(_coarse(spark, sf_dir), "t_us", "value", WINDOWS, exact_ties=True, tie_col="event_id"))


def _lag_sql(partition: str = "") -> str:
    part = f"PARTITION BY {partition} " if partition else ""
    cols = ",\n       ".join(
        f"coalesce(CAST(lag(value, {k}) OVER w AS DOUBLE), first_value(value) OVER w, 0.0) AS value_lag_{k}"
        for k in range(1, 11))
    key = f"{partition}, " if partition else ""
    return f"""
SELECT event_id, {key}row_number() OVER w - 1 AS row_idx, value,
       {cols}
FROM (SELECT event_id, user_id, value, epoch_us(ts) AS t_us FROM events)
WINDOW w AS ({part}ORDER BY t_us, event_id)
"""


@register("W4_W5_global_lags_backfill", _lag_sql())
def w4(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", "t_us", "value")
    return lag_features(ev, EV_ORDER, "value", range(1, 11)).select(
        "event_id", "row_idx", "value", *[f"value_lag_{k}" for k in range(1, 11)])


@register("W4_W5_per_key_lags_backfill", _lag_sql("user_id"))
def w4k(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", "user_id", "t_us", "value")
    return lag_features(ev, EV_ORDER, "value", range(1, 11), partition_by=["user_id"]).select(
        "event_id", "user_id", "row_idx", "value", *[f"value_lag_{k}" for k in range(1, 11)])


@register("F9_rolling_lag_features", f"""
WITH e AS (SELECT event_id, value, epoch_us(ts) AS t_us FROM events)
SELECT event_id, value,
       {_roll_sql_cols()},
       coalesce(lag(value, 1) OVER w, first_value(value) OVER w, 0.0) AS value_lag_1,
       coalesce(lag(value, 2) OVER w, first_value(value) OVER w, 0.0) AS value_lag_2,
       coalesce(lag(value, 3) OVER w, first_value(value) OVER w, 0.0) AS value_lag_3
FROM e WINDOW w AS (ORDER BY t_us, event_id)
""")
def f9(spark, sf_dir):
    from ..operators.features import RollingLagFeatures
    ev = _events(spark, sf_dir).select("event_id", "t_us", "value")
    out = RollingLagFeatures(t_col="t_us", value_col="value", windows=WINDOWS, lags=(1, 2, 3),
                             tie_col="event_id").transform(ev)
    return round_doubles(out.drop("t_us", "row_idx"))


def _top_user_sql():
    return "(SELECT user_id FROM events GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1)"


@register("W7_resample_top_user_hourly", f"""
WITH u AS {_top_user_sql()},
e AS (SELECT epoch_us(ts) // {H} AS b, value FROM events WHERE user_id = (SELECT user_id FROM u)),
g AS (SELECT b, avg(value) AS mean_value, count(value) AS n_events FROM e GROUP BY b),
s AS (SELECT range AS b FROM range((SELECT min(b) FROM e), (SELECT max(b) FROM e) + 1))
SELECT s.b * {H} AS bin_start, g.mean_value, coalesce(g.n_events, 0) AS n_events
FROM s LEFT JOIN g ON s.b = g.b
""")
def w7(spark, sf_dir):
    from ..operators.stats import most_frequent
    ev = _events(spark, sf_dir)
    top = most_frequent(ev, "user_id")
    one = ev.join(F.broadcast(top.select("user_id")), "user_id", "left_semi")
    return resample(one, "t_us", H, {"mean_value": F.avg("value"), "n_events": F.count("value")})


@register("W8_A12_grouped_hourly_counts_pivot", f"""
WITH e AS (SELECT event_type, epoch_us(ts) // {H} AS b FROM events),
c AS (SELECT event_type, b, count(*) AS n FROM e GROUP BY ALL),
s AS (SELECT event_type, unnest(generate_series(min(b), max(b))) AS b FROM e GROUP BY event_type),
l AS (SELECT s.event_type, s.b, coalesce(c.n, 0) AS n FROM s LEFT JOIN c USING (event_type, b))
SELECT b * {H} AS bin_start,
       sum(CASE WHEN event_type = 'click' THEN n ELSE 0 END) AS click,
       sum(CASE WHEN event_type = 'error' THEN n ELSE 0 END) AS error,
       sum(CASE WHEN event_type = 'purchase' THEN n ELSE 0 END) AS purchase,
       sum(CASE WHEN event_type = 'signup' THEN n ELSE 0 END) AS signup,
       sum(CASE WHEN event_type = 'view' THEN n ELSE 0 END) AS view
FROM l GROUP BY b
""")
def w8(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return grouped_bin_counts(ev, "event_type", "t_us", H)


@register("W11_per_key_sequences_30", """
WITH e AS (SELECT user_id, event_id, value, epoch_us(ts) AS t_us FROM events),
s AS (SELECT user_id, row_number() OVER w - 1 AS row_idx,
             list(value) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS seq, value AS target
      FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t_us, event_id))
SELECT * FROM s WHERE row_idx >= 29
""")
def w11(spark, sf_dir):
    ev = _events(spark, sf_dir).select("user_id", "event_id", "value", "t_us")
    return sliding_sequences(ev, EV_ORDER, ["value"], 30, target_col="value", partition_by=["user_id"])


@register("W12_global_sequences_30", """
WITH e AS (SELECT event_id, value, epoch_us(ts) AS t_us FROM events),
s AS (SELECT row_number() OVER w - 1 AS row_idx,
             list(value) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS seq, value AS target
      FROM e WINDOW w AS (ORDER BY t_us, event_id))
SELECT * FROM s WHERE row_idx >= 29
""")
def w12(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", "value", "t_us")
    return sliding_sequences(ev, EV_ORDER, ["value"], 30, target_col="value")


@register("W13_T4_context_of_top_values", """
WITH e AS (SELECT event_id, value, row_number() OVER (ORDER BY epoch_us(ts), event_id) - 1 AS row_idx
           FROM events),
n AS (SELECT count(*) AS n FROM events),
c AS (SELECT row_idx AS centre_idx FROM e ORDER BY value DESC, event_id LIMIT 10),
r AS (SELECT centre_idx, unnest(generate_series(greatest(0, centre_idx - 10),
                                                least(n, greatest(0, centre_idx - 10) + 20) - 1)) AS row_idx
      FROM c, n)
SELECT r.centre_idx, e.row_idx, e.event_id, e.value FROM r JOIN e USING (row_idx)
""")
def w13(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", "value", "t_us")
    idx, n = with_row_index(ev, EV_ORDER)
    centres = idx.orderBy(F.col("value").desc(), "event_id").limit(10).select("row_idx")
    return context_rows(idx, centres, n).select("centre_idx", "row_idx", "event_id", "value")
