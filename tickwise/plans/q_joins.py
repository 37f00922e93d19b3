"""Join queries: dimension joins, keep-first joins, as-of joins (J1-J4, J8 shape)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.asof import asof_join
from ..operators.joins import left_join_dimension, left_join_first
from ..session import cut_lineage, micros
from ..sources.tables import Tables
from .registry import register

HOUR_US = 3_600_000_000
TOL_US = 6 * HOUR_US            # as-of tolerance on the events stand-in
NOKEY_TOL_US = 10 * 60_000_000  # 10 minutes for the key-less as-of


def _events_split(t: Tables):
    ev = t.events
    left = ev.where(F.col("event_type") != "error").select(
        "event_id", "user_id", "event_type", "value", micros("ts").alias("t_us"))
    right = ev.where(F.col("event_type") == "error").select(
        F.col("event_id").alias("err_id"), "user_id", F.col("value").alias("err_value"),
        micros("ts").alias("err_t_us"))
    return left, right


def nearest_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each non-error event with the nearest error event of the same user
    within 6 h (pandas merge_asof nearest + tolerance semantics)."""
    left, right = _events_split(Tables(spark, sf_dir))
    return asof_join(left, right, on="t_us", right_on="err_t_us", by="user_id",
                     tolerance=TOL_US, direction="nearest", right_tie="err_id",
                     distance_col="gap_us")


_NEAREST_SQL = f"""
WITH l AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) AS t_us
           FROM events WHERE event_type <> 'error'),
r AS (SELECT event_id AS err_id, user_id, value AS err_value, epoch_us(ts) AS err_t_us
      FROM events WHERE event_type = 'error'),
c AS (SELECT l.event_id, r.err_id, r.err_value, abs(l.t_us - r.err_t_us) AS gap_us,
             row_number() OVER (PARTITION BY l.event_id
                                ORDER BY abs(l.t_us - r.err_t_us),
                                         CASE WHEN r.err_t_us <= l.t_us THEN 0 ELSE 1 END,
                                         CASE WHEN r.err_t_us <= l.t_us THEN -r.err_id ELSE r.err_id END) AS rn
      FROM l JOIN r ON l.user_id = r.user_id
       AND r.err_t_us BETWEEN l.t_us - {TOL_US} AND l.t_us + {TOL_US})
SELECT l.event_id, l.user_id, l.event_type, l.value, l.t_us, c.err_id, c.err_value, c.gap_us
FROM l LEFT JOIN c ON c.event_id = l.event_id AND c.rn = 1
"""

register("J3_asof_nearest_by_key", _NEAREST_SQL)(nearest_error)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 -> J3 -> J1 -> A9: as-of enrichment, dimension joins, named aggregation."""
    t = Tables(spark, sf_dir)
    enriched = nearest_error(spark, sf_dir)
    cust = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    nat = t.nation.select("n_nationkey", "n_regionkey")
    reg = t.region.select("r_regionkey", "r_name")
    x = left_join_dimension(enriched, cust, "user_id", "c_custkey")
    x = left_join_dimension(x, nat, "c_nationkey", "n_nationkey")
    x = left_join_dimension(x, reg, "n_regionkey", "r_regionkey")
    return x.groupBy("event_type", "r_name").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count("err_id").alias("n_matched"),
        F.round(F.avg("value"), 6).alias("mean_value"),
        F.round(F.stddev_samp("value"), 6).alias("std_value"),
        F.round(F.avg("gap_us") / 60e6, 6).alias("mean_gap_min"),
    )


_FLAGSHIP_SQL = f"""
WITH e AS ({_NEAREST_SQL}),
x AS (SELECT e.*, r.r_name FROM e
      LEFT JOIN customer c ON e.user_id = c.c_custkey
      LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
      LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT event_type, r_name, count(*) AS n_events, count(err_id) AS n_matched,
       round(avg(value), 6) AS mean_value, round(stddev_samp(value), 6) AS std_value,
       round(avg(gap_us) / 60e6, 6) AS mean_gap_min
FROM x GROUP BY event_type, r_name
"""

register("A9_J3_J1_asof_enrich_rollup", _FLAGSHIP_SQL)(flagship)


@register("J1_left_join_dimension", """
SELECT e.event_id, e.user_id, e.event_type, c.c_name, c.c_mktsegment, n.n_name
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def j1(spark, sf_dir):
    t = Tables(spark, sf_dir)
    ev = t.events.select("event_id", "user_id", "event_type")
    x = left_join_dimension(ev, t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"),
                            "user_id", "c_custkey")
    x = left_join_dimension(x, t.nation.select("n_nationkey", "n_name"), "c_nationkey", "n_nationkey")
    return x.select("event_id", "user_id", "event_type", "c_name", "c_mktsegment", "n_name")


@register("J2_left_join_keep_first", """
WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
           QUALIFY row_number() OVER (PARTITION BY l_orderkey
                                      ORDER BY l_linenumber, l_partkey, l_suppkey) = 1)
SELECT o.o_orderkey, o.o_orderpriority, o.o_totalprice, f.l_linenumber, f.l_partkey, f.l_quantity
FROM orders o LEFT JOIN f ON o.o_orderkey = f.l_orderkey
""")
def j2(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    x = left_join_first(o, li, "o_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"],
                        other_key="l_orderkey")
    return x.select("o_orderkey", "o_orderpriority", "o_totalprice", "l_linenumber", "l_partkey",
                    "l_quantity")


@register("J4_asof_nearest_no_key", f"""
WITH l AS (SELECT event_id, event_type, epoch_us(ts) AS t_us FROM events WHERE event_type <> 'error'),
r AS (SELECT event_id AS err_id, user_id AS err_user, epoch_us(ts) AS err_t_us
      FROM events WHERE event_type = 'error'),
c AS (SELECT l.event_id, r.err_id, r.err_user, abs(l.t_us - r.err_t_us) AS gap_us,
             row_number() OVER (PARTITION BY l.event_id
                                ORDER BY abs(l.t_us - r.err_t_us),
                                         CASE WHEN r.err_t_us <= l.t_us THEN 0 ELSE 1 END,
                                         CASE WHEN r.err_t_us <= l.t_us THEN -r.err_id ELSE r.err_id END) AS rn
      FROM l JOIN r ON r.err_t_us BETWEEN l.t_us - {NOKEY_TOL_US} AND l.t_us + {NOKEY_TOL_US})
SELECT l.event_id, l.event_type, l.t_us, c.err_id, c.err_user, c.gap_us
FROM l LEFT JOIN c ON c.event_id = l.event_id AND c.rn = 1
""")
def j4(spark, sf_dir):
    t = Tables(spark, sf_dir)
    ev = t.events
    left = ev.where(F.col("event_type") != "error").select(
        "event_id", "event_type", micros("ts").alias("t_us"))
    right = ev.where(F.col("event_type") == "error").select(
        F.col("event_id").alias("err_id"), F.col("user_id").alias("err_user"),
        micros("ts").alias("err_t_us"))
    return asof_join(left, right, on="t_us", right_on="err_t_us", tolerance=NOKEY_TOL_US,
                     right_tie="err_id", distance_col="gap_us")


@register("J3_asof_backward_unbounded", """
WITH l AS (SELECT event_id, user_id, epoch_us(ts) AS t_us FROM events WHERE event_type = 'purchase'),
r AS (SELECT event_id AS prev_id, user_id, epoch_us(ts) AS prev_t_us FROM events WHERE event_type = 'signup')
SELECT l.event_id, l.user_id, l.t_us, r.prev_id, l.t_us - r.prev_t_us AS gap_us
FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.t_us >= r.prev_t_us
""")
def j3_unbounded(spark, sf_dir):
    """Backward as-of without tolerance: last signup of the user at or before
    each purchase, however old (bucket carry across days)."""
    ev = Tables(spark, sf_dir).events
    left = ev.where(F.col("event_type") == "purchase").select(
        "event_id", "user_id", micros("ts").alias("t_us"))
    right = ev.where(F.col("event_type") == "signup").select(
        F.col("event_id").alias("prev_id"), "user_id", micros("ts").alias("prev_t_us"))
    return asof_join(left, right, on="t_us", right_on="prev_t_us", by="user_id",
                     direction="backward", bucket_width=24 * HOUR_US, right_tie="prev_id",
                     distance_col="gap_us")


@register("T7_J5_J3_J2_J1_combined_table_build", f"""
WITH sp AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) AS t_us FROM events WHERE event_type <> 'error'),
d AS (SELECT sp.*, c.c_nationkey, c.c_acctbal, c.c_mktsegment FROM sp LEFT JOIN customer c ON sp.user_id = c.c_custkey),
fo AS (SELECT o_custkey, o_orderkey AS first_orderkey, o_orderpriority FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1),
f AS (SELECT d.*, fo.first_orderkey, fo.o_orderpriority FROM d LEFT JOIN fo ON d.user_id = fo.o_custkey),
r AS (SELECT event_id AS err_id, user_id, value AS err_value, epoch_us(ts) AS err_t_us FROM events WHERE event_type = 'error'),
c AS (SELECT f.event_id, r.err_id, r.err_value,
             row_number() OVER (PARTITION BY f.event_id
                                ORDER BY abs(f.t_us - r.err_t_us), CASE WHEN r.err_t_us <= f.t_us THEN 0 ELSE 1 END,
                                         CASE WHEN r.err_t_us <= f.t_us THEN -r.err_id ELSE r.err_id END) AS rn
      FROM f JOIN r ON f.user_id = r.user_id AND r.err_t_us BETWEEN f.t_us - {TOL_US} AND f.t_us + {TOL_US}),
a AS (SELECT f.*, c.err_id, c.err_value FROM f LEFT JOIN c ON c.event_id = f.event_id AND c.rn = 1),
z AS (SELECT a.*, row_number() OVER (ORDER BY t_us, event_id) - 1 AS row_idx FROM a),
ctl AS (SELECT l_quantity AS queue_qty, l_discount AS ctl_discount, l_returnflag AS controller_state,
               row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS zi
        FROM lineitem),
comb AS (SELECT z.*, ctl.queue_qty, ctl.ctl_discount, ctl.controller_state FROM z LEFT JOIN ctl ON z.row_idx = ctl.zi),
p AS (SELECT count(*) // 5 AS n, count(*) AS n_tot FROM comb),
cs AS (SELECT coalesce(event_type, '<null>') AS s, count(*) AS cnt FROM comb GROUP BY 1),
t AS (SELECT s, cnt, CAST(round_even(cnt / n_tot * n, 0) AS BIGINT) AS target, n FROM cs, p),
tg AS (SELECT s, cnt, target + CASE WHEN row_number() OVER (ORDER BY target DESC, cnt DESC, s) = 1
                                    THEN n - sum(target) OVER () ELSE 0 END AS target FROM t),
rk AS (SELECT comb.*, coalesce(event_type, '<null>') AS s,
              row_number() OVER (PARTITION BY coalesce(event_type, '<null>')
                                 ORDER BY md5(concat('42', CAST(event_id AS VARCHAR))), event_id) AS k FROM comb)
SELECT event_id, user_id, event_type, value, t_us, c_nationkey, c_acctbal, c_mktsegment, first_orderkey,
       o_orderpriority, err_id, err_value, row_idx, queue_qty, ctl_discount, controller_state
FROM rk JOIN tg USING (s) WHERE k <= least(greatest(tg.target, 0), tg.cnt)
""")
def combined_build(spark, sf_dir):
    """The combined-table build: event spine -> device (customer) join ->
    keep-first order per customer -> nearest error within 6 h -> positional
    controller columns (line items in file order) -> exact stratified 20 %
    sample by event type."""
    from ..operators.order import zip_join
    from ..operators.sample import stratified_sample
    t = Tables(spark, sf_dir)
    left, right = _events_split(t)
    x = left_join_dimension(left, t.customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"),
                            "user_id", "c_custkey")
    orders = t.orders.select("o_custkey", F.col("o_orderkey").alias("first_orderkey"), "o_orderpriority",
                             "o_orderdate")
    x = left_join_first(x, orders, "user_id", ["o_orderdate", "first_orderkey"], other_key="o_custkey").drop(
        "o_orderdate")
    x = asof_join(x, right.select("err_id", "user_id", "err_value", "err_t_us"), on="t_us", right_on="err_t_us",
                  by="user_id", tolerance=TOL_US, right_tie="err_id")
    ctl = t.lineitem.select(F.col("l_quantity").alias("queue_qty"), F.col("l_discount").alias("ctl_discount"),
                            F.col("l_returnflag").alias("controller_state"), "l_shipdate", "l_orderkey",
                            "l_linenumber", "l_partkey", "l_suppkey")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    # the combined table is written once (as the reference saves it); the
    # sample's counts, histogram and pick then read it instead of re-joining
    z = cut_lineage(zip_join(x, ["t_us", "event_id"], ctl, order).drop(*order))
    n = z.count() // 5
    return stratified_sample(z, n, 42, ["event_type", "latency_violation"], "event_id")
