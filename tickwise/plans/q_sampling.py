"""Sampling queries: exact stratified sample, exact random sample, seeded noise
(T7, T8, C14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.sample import inject_noise, random_sample, stratified_sample
from ..sources.tables import Tables
from .registry import register, round_doubles

SEED = 42


def _strat_sql(table: str, strata: list[str], key: str, frac_div: int, cols: str) -> str:
    skey = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '<null>')" for c in strata)
    return f"""
WITH p AS (SELECT count(*) // {frac_div} AS n, count(*) AS n_tot FROM {table}),
c AS (SELECT {skey} AS s, count(*) AS cnt FROM {table} GROUP BY 1),
t AS (SELECT s, cnt, CAST(round_even(cnt / n_tot * n, 0) AS BIGINT) AS target, n FROM c, p),
a AS (SELECT s, cnt, target + CASE WHEN row_number() OVER (ORDER BY target DESC, cnt DESC, s) = 1
                                   THEN n - sum(target) OVER () ELSE 0 END AS target FROM t),
r AS (SELECT *, {skey} AS s,
             row_number() OVER (PARTITION BY {skey}
                                ORDER BY md5(concat('{SEED}', CAST({key} AS VARCHAR))), {key}) AS rk
      FROM {table})
SELECT {cols} FROM r JOIN a USING (s) WHERE rk <= least(greatest(a.target, 0), a.cnt)
"""


@register("T7_stratified_sample_events", _strat_sql("events", ["event_type"], "event_id", 5,
                                                     "event_id, event_type, user_id, value"))
def t7(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.select("event_id", "event_type", "user_id", "value")
    n = ev.count() // 5
    return stratified_sample(ev, n, SEED, ["event_type"], "event_id")


@register("T7_stratified_sample_two_columns",
          _strat_sql("(SELECT l_orderkey * 8 + l_linenumber AS lkey, * FROM lineitem)",
                     ["l_returnflag", "l_linestatus"], "lkey", 10,
                     "lkey, l_returnflag, l_linestatus, l_quantity"))
def t7b(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("lkey"), "l_returnflag", "l_linestatus",
        "l_quantity", "l_partkey", "l_suppkey")
    n = li.count() // 10
    out = stratified_sample(li, n, SEED, ["l_returnflag", "l_linestatus"], "lkey")
    return out.select("lkey", "l_returnflag", "l_linestatus", "l_quantity")


@register("T8_random_sample_orders", f"""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
QUALIFY row_number() OVER (ORDER BY md5(concat('{SEED}', CAST(o_orderkey AS VARCHAR))), o_orderkey)
        <= (SELECT count(*) // 10 FROM orders)
""")
def t8(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return random_sample(o, o.count() // 10, SEED, "o_orderkey")


@register("C14_E10_gaussian_noise_grid", """
WITH s AS (SELECT stddev_samp(value) AS sd FROM events),
lv AS (SELECT i, CAST(lvl AS DOUBLE) AS lvl FROM (VALUES (0, 0.0), (1, 0.5), (2, 2.0)) t(i, lvl)),
z AS (SELECT event_id, value, lvl,
             sqrt(-2.0 * ln((CAST(('0x' || substr(md5(concat(CAST(42 + i AS VARCHAR), '|', CAST(event_id AS VARCHAR), '|1')), 1, 13)) AS BIGINT) + 1) / 4503599627370497.0))
             * cos(6.283185307179586 * CAST(('0x' || substr(md5(concat(CAST(42 + i AS VARCHAR), '|', CAST(event_id AS VARCHAR), '|2')), 1, 13)) AS BIGINT) / 4503599627370496.0) AS z
      FROM events, lv)
SELECT event_id, round(value + z * (lvl * (SELECT sd FROM s)), 8) AS value, round(lvl, 8) AS noise_level FROM z
""")
def c14(spark, sf_dir):
    """Noise levels 0, 0.5, 2.0 sigma on ``value``; one copy of the rows per level
    (grid is a 3-element parameter)."""
    ev = Tables(spark, sf_dir).events.select("event_id", "value")
    parts = [inject_noise(ev, "value", lvl, SEED + i, "event_id").withColumn("noise_level", F.lit(lvl))
             for i, lvl in enumerate((0.0, 0.5, 2.0))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return round_doubles(out)
