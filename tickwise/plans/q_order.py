"""Positional queries: global index, chronological splits, folds, slices,
positional zip join, systematic sample (W14, W9, W10, P10, J5, T9)."""

from __future__ import annotations


from ..operators.order import (chrono_split, expanding_folds, positional_slice, systematic_sample,
                               with_row_index, zip_join)
from ..session import micros
from ..sources.tables import Tables
from .registry import register

EV_ORDER = ["t_us", "event_id"]


def _events(spark, sf_dir):
    return Tables(spark, sf_dir).events.select("event_id", "user_id", "event_type", "value",
                                               micros("ts").alias("t_us"))


@register("W14_global_row_index", """
SELECT event_id, user_id, epoch_us(ts) AS t_us,
       row_number() OVER (ORDER BY epoch_us(ts), event_id) - 1 AS row_idx
FROM events
""")
def w14(spark, sf_dir):
    df, _ = with_row_index(_events(spark, sf_dir).select("event_id", "user_id", "t_us"), EV_ORDER)
    return df


@register("W9_chronological_split", """
WITH o AS (SELECT o_orderkey, o_orderdate,
                  row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_idx,
                  count(*) OVER () AS n FROM orders)
SELECT o_orderkey, row_idx,
       CASE WHEN row_idx < CAST(floor(n * 0.7) AS BIGINT) THEN 'train'
            WHEN row_idx < CAST(floor(n * (0.7 + 0.15)) AS BIGINT) THEN 'val' ELSE 'test' END AS split
FROM o
""")
def w9(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderdate")
    return chrono_split(o, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "row_idx", "split")


def _fold_sql(k: int) -> str:
    # boundaries int(round(i*n/(k+1))) with half-even rounding
    return f"""
WITH o AS (SELECT event_id, row_number() OVER (ORDER BY epoch_us(ts), event_id) - 1 AS row_idx,
                  count(*) OVER () AS n FROM events),
f AS (SELECT range + 1 AS fold FROM range({k})),
b AS (SELECT fold, CAST(round_even(fold * n / {k + 1}.0, 0) AS BIGINT) AS tr_end,
             CAST(round_even((fold + 1) * n / {k + 1}.0, 0) AS BIGINT) AS va_end
      FROM f, (SELECT count(*) AS n FROM events))
SELECT o.event_id, o.row_idx, b.fold, CASE WHEN o.row_idx < b.tr_end THEN 'train' ELSE 'val' END AS role
FROM o JOIN b ON o.row_idx < b.va_end
WHERE b.tr_end > 0 AND b.va_end > b.tr_end
"""


@register("W10_expanding_cv_folds", _fold_sql(4))
def w10(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", "t_us")
    return expanding_folds(ev, EV_ORDER, n_splits=4).select("event_id", "row_idx", "fold", "role")


@register("P10_positional_middle_slice", """
WITH o AS (SELECT l_orderkey, l_linenumber, l_quantity,
                  row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS row_idx,
                  count(*) OVER () AS n FROM lineitem)
SELECT l_orderkey, l_linenumber, l_quantity, row_idx FROM o
WHERE row_idx >= CAST(floor(n * 0.25) AS BIGINT) AND row_idx < CAST(floor(n * 0.5) AS BIGINT)
""")
def p10(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                               "l_quantity", "l_shipdate")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return positional_slice(li, order, frac=(0.25, 0.5)).select(
        "l_orderkey", "l_linenumber", "l_quantity", "row_idx")


@register("J5_positional_zip_join", """
WITH s AS (SELECT event_id, user_id, row_number() OVER (ORDER BY epoch_us(ts), event_id) - 1 AS row_idx
           FROM events),
c AS (SELECT o_orderkey, o_orderstatus, o_totalprice,
             row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS zidx FROM orders)
SELECT s.event_id, s.user_id, s.row_idx, c.o_orderkey, c.o_orderstatus, c.o_totalprice
FROM s LEFT JOIN c ON s.row_idx = c.zidx
""")
def j5(spark, sf_dir):
    t = Tables(spark, sf_dir)
    spine = _events(spark, sf_dir).select("event_id", "user_id", "t_us")
    ctrl = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    z = zip_join(spine, EV_ORDER, ctrl, ["o_orderdate", "o_orderkey"])
    return z.select("event_id", "user_id", "row_idx", "o_orderkey", "o_orderstatus", "o_totalprice")


@register("T9_systematic_sample_500", """
WITH o AS (SELECT event_id, value, row_number() OVER (ORDER BY epoch_us(ts), event_id) - 1 AS row_idx,
                  count(*) OVER () AS n FROM events)
SELECT event_id, value, row_idx FROM o
WHERE row_idx IN (SELECT DISTINCT (i * (n - 1)) // 499 FROM range(500) t(i), (SELECT count(*) AS n FROM events))
""")
def t9(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", "value", "t_us")
    return systematic_sample(ev, EV_ORDER, 500).select("event_id", "value", "row_idx")
