"""Profiling, aggregation and statistics queries (A1-A18, A23-A25, T1-T3, C*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expr import binary_target, coerce_numeric, lenient_bool, residuals, strata_key
from ..operators import stats as S
from ..operators.order import chrono_split
from ..sources.tables import Tables
from .registry import histogram_sql, r8, register, round_doubles

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _li(spark, sf_dir):
    return Tables(spark, sf_dir).lineitem


def _union(parts):
    return "\nUNION ALL\n".join(parts)


_A1_COLS = ["event_id", "user_id", "event_type", "value", "t_us", "err_id", "err_value", "gap_us"]


@register("A1_missing_summary_after_asof", "WITH e AS (" + __import__(
    "tickwise.plans.q_joins", fromlist=["_NEAREST_SQL"])._NEAREST_SQL + "),\nm AS (" + _union([
        f"SELECT {i} AS i, '{c}' AS \"column\", count(*) - count({c}) AS missing, "
        f"round((count(*) - count({c})) / count(*) * 100, 2) AS pct FROM e"
        for i, c in enumerate(_A1_COLS)]) + """)
SELECT CAST(row_number() OVER (ORDER BY missing DESC, i) - 1 AS INTEGER) AS position, "column", missing, pct FROM m""")
def a1(spark, sf_dir):
    from .q_joins import nearest_error
    return S.missing_summary(nearest_error(spark, sf_dir))


_DUCK_TO_SPARK = ("CASE typeof({c}) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
                  "WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' "
                  "WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE typeof({c}) END")
_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("A2_table_profile", _union([
    f"SELECT 'lineitem' AS \"table\", count(*) AS n_rows, {len(_LI_COLS)} AS n_columns, '{c}' AS \"column\", "
    f"any_value({_DUCK_TO_SPARK.format(c=c)}) AS dtype, count(*) - count({c}) AS missing, count({c}) AS non_null "
    f"FROM lineitem" for c in _LI_COLS]))
def a2(spark, sf_dir):
    return S.profile(_li(spark, sf_dir), "lineitem")


@register("A3_distinct_counts", _union([
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM lineitem"
    for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate"]]))
def a3(spark, sf_dir):
    return S.distinct_counts(_li(spark, sf_dir),
                             ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
                              "l_shipdate"])


@register("A4_numeric_summary", _union([
    f"SELECT '{c}' AS \"column\", CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
    f"round(quantile_cont({c}, 0.5), 8) AS median, round(avg({c}), 8) AS mean FROM lineitem"
    for c in LI_NUM]))
def a4(spark, sf_dir):
    return round_doubles(S.numeric_summary(_li(spark, sf_dir), LI_NUM))


@register("A5_describe_by_group", _union([
    f"SELECT l_returnflag, '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 8) AS mean, "
    f"round(stddev_samp({c}), 8) AS std, CAST(min({c}) AS DOUBLE) AS min, "
    f"round(quantile_cont({c}, 0.25), 8) AS p25, round(quantile_cont({c}, 0.5), 8) AS p50, "
    f"round(quantile_cont({c}, 0.75), 8) AS p75, CAST(max({c}) AS DOUBLE) AS max "
    f"FROM lineitem GROUP BY l_returnflag" for c in LI_NUM]))
def a5(spark, sf_dir):
    return round_doubles(S.describe(_li(spark, sf_dir), LI_NUM, by=["l_returnflag"]))


@register("A6_value_counts_normalized", """
SELECT o_orderpriority, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 8) AS share
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority
""")
def a6(spark, sf_dir):
    return round_doubles(S.value_counts(Tables(spark, sf_dir).orders, "o_orderpriority", normalize=True))


@register("A7_T3_top5_customers_by_orders", """
SELECT o_custkey, count(*) AS count FROM orders WHERE o_custkey IS NOT NULL
GROUP BY o_custkey ORDER BY count DESC, o_custkey LIMIT 5
""")
def a7(spark, sf_dir):
    return S.top_k_by_count(Tables(spark, sf_dir).orders, "o_custkey", 5)


@register("A8_group_mean", """
SELECT o_orderstatus, round(avg(o_totalprice), 8) AS mean_o_totalprice FROM orders
WHERE o_orderstatus IS NOT NULL GROUP BY o_orderstatus
""")
def a8(spark, sf_dir):
    return round_doubles(S.group_mean(Tables(spark, sf_dir).orders, "o_orderstatus", "o_totalprice"))


@register("A10_two_key_named_agg", """
SELECT l_returnflag, l_linestatus, count(*) AS n, round(avg(l_extendedprice), 8) AS mean_price,
       round(stddev_samp(l_extendedprice), 8) AS std_price, round(sum(l_quantity), 8) AS sum_qty,
       round(avg(l_discount) * 100, 8) AS mean_discount_pct
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def a10(spark, sf_dir):
    return round_doubles(S.named_agg(_li(spark, sf_dir), ["l_returnflag", "l_linestatus"], {
        "n": F.count(F.lit(1)), "mean_price": F.avg("l_extendedprice"),
        "std_price": F.stddev_samp("l_extendedprice"), "sum_qty": F.sum("l_quantity"),
        "mean_discount_pct": F.avg("l_discount") * 100}))


@register("A11_pivot_mean", """
SELECT l_returnflag,
       round(avg(CASE WHEN l_linestatus = 'F' THEN l_extendedprice END), 8) AS "F",
       round(avg(CASE WHEN l_linestatus = 'O' THEN l_extendedprice END), 8) AS "O"
FROM lineitem GROUP BY l_returnflag
""")
def a11(spark, sf_dir):
    return round_doubles(S.pivot_mean(_li(spark, sf_dir), "l_returnflag", "l_linestatus", "l_extendedprice"))


_PAIRS = [(a, b) for i, a in enumerate(LI_NUM) for b in LI_NUM[i + 1:]]


@register("A13_pairwise_correlation", _union([
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) AS r FROM lineitem" for a, b in _PAIRS]))
def a13(spark, sf_dir):
    return round_doubles(S.corr_pairs(_li(spark, sf_dir), LI_NUM))


@register("T2_top_correlated_with_target", """
SELECT feature, r FROM (""" + _union([
    f"SELECT '{c}' AS feature, round(corr({c}, l_extendedprice), 8) AS r FROM lineitem"
    for c in ["l_quantity", "l_discount", "l_tax", "l_linenumber"]]) + """)
WHERE r IS NOT NULL ORDER BY abs(r) DESC, feature LIMIT 15
""")
def t2(spark, sf_dir):
    return round_doubles(S.top_correlated(_li(spark, sf_dir), "l_extendedprice",
                                          ["l_quantity", "l_discount", "l_tax", "l_linenumber"], 15))


@register("A14_equal_width_histogram_80", "WITH " + histogram_sql("lineitem", "l_extendedprice", 80))
def a14(spark, sf_dir):
    return round_doubles(S.histogram(_li(spark, sf_dir), "l_extendedprice", 80))


@register("A15_box_summary_by_group", """
WITH q AS (SELECT o_orderpriority, count(o_totalprice) AS n, quantile_cont(o_totalprice, 0.25) AS q1,
                  quantile_cont(o_totalprice, 0.5) AS median, quantile_cont(o_totalprice, 0.75) AS q3
           FROM orders WHERE o_totalprice IS NOT NULL GROUP BY o_orderpriority),
j AS (SELECT o.o_orderpriority, o.o_totalprice AS v, q1, q3, q3 - q1 AS iqr FROM orders o JOIN q USING (o_orderpriority)
      WHERE o.o_totalprice IS NOT NULL),
w AS (SELECT o_orderpriority,
             min(CASE WHEN v >= q1 - 1.5 * iqr AND v <= q3 + 1.5 * iqr THEN v END) AS whisker_lo,
             max(CASE WHEN v >= q1 - 1.5 * iqr AND v <= q3 + 1.5 * iqr THEN v END) AS whisker_hi,
             sum(CASE WHEN v >= q1 - 1.5 * iqr AND v <= q3 + 1.5 * iqr THEN 0 ELSE 1 END) AS n_outliers
      FROM j GROUP BY o_orderpriority)
SELECT o_orderpriority, n, round(q1, 8) AS q1, round(median, 8) AS median, round(q3, 8) AS q3,
       round(q3 - q1, 8) AS iqr, round(whisker_lo, 8) AS whisker_lo, round(whisker_hi, 8) AS whisker_hi, n_outliers
FROM q JOIN w USING (o_orderpriority)
""")
def a15(spark, sf_dir):
    return round_doubles(S.box_summary(Tables(spark, sf_dir).orders, "o_orderpriority", "o_totalprice"))


@register("A16_exact_p95_by_group", """
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.95), 8) AS p95_price
FROM lineitem GROUP BY l_returnflag
""")
def a16(spark, sf_dir):
    return round_doubles(S.percentile_by(_li(spark, sf_dir), ["l_returnflag"], "l_extendedprice", 0.95,
                                         "p95_price"))


@register("A17_argmin_label_per_group", """
WITH m AS (SELECT o_orderpriority, o_orderstatus, avg(o_totalprice) AS mean_price FROM orders
           GROUP BY ALL)
SELECT o_orderpriority, arg_min(o_orderstatus, (mean_price, o_orderstatus)) AS o_orderstatus,
       round(min(mean_price), 8) AS mean_price
FROM m WHERE mean_price IS NOT NULL GROUP BY o_orderpriority
""")
def a17(spark, sf_dir):
    m = Tables(spark, sf_dir).orders.groupBy("o_orderpriority", "o_orderstatus").agg(
        F.avg("o_totalprice").alias("mean_price"))
    return round_doubles(S.argmin_by_group(m, "o_orderpriority", "o_orderstatus", "mean_price"))


@register("A18_top10_suppliers_by_revenue", """
SELECT l_suppkey, round(sum(l_extendedprice * (1 - l_discount)), 8) AS total FROM lineitem
WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey ORDER BY sum(l_extendedprice * (1 - l_discount)) DESC, l_suppkey LIMIT 10
""")
def a18(spark, sf_dir):
    li = _li(spark, sf_dir).withColumn("rev", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return round_doubles(S.top_k_groups_by_sum(li, "l_suppkey", "rev", 10))


@register("A23_mean_popstd_by_group", """
SELECT o_orderpriority, round(avg(o_totalprice), 8) AS mean, round(stddev_pop(o_totalprice), 8) AS std
FROM orders GROUP BY o_orderpriority
""")
def a23(spark, sf_dir):
    return round_doubles(S.mean_popstd(Tables(spark, sf_dir).orders, ["o_orderpriority"], "o_totalprice"))


@register("A24_groups_with_at_least_10", """
SELECT count(*) AS n_groups, sum(CASE WHEN size >= 10 THEN 1 ELSE 0 END) AS n_groups_ge_k
FROM (SELECT o_custkey, count(*) AS size FROM orders GROUP BY o_custkey)
""")
def a24(spark, sf_dir):
    return S.count_groups_at_least(Tables(spark, sf_dir).orders, "o_custkey", 10)


@register("A25_W9_C8_class_rate_per_split", """
WITH o AS (SELECT o_totalprice, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_idx,
                  count(*) OVER () AS n FROM orders),
s AS (SELECT CASE WHEN row_idx < CAST(floor(n * 0.7) AS BIGINT) THEN 'train'
                  WHEN row_idx < CAST(floor(n * (0.7 + 0.15)) AS BIGINT) THEN 'val' ELSE 'test' END AS split,
             coalesce(CAST(o_totalprice > 250000.0 AS INTEGER), 0) AS y FROM o)
SELECT split, count(*) AS n, round(avg(y), 8) AS positive_rate FROM s GROUP BY split
""")
def a25(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    s = chrono_split(o, ["o_orderdate", "o_orderkey"]).withColumn("y", binary_target("o_totalprice", 250000.0))
    return round_doubles(s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("positive_rate")))


@register("C2_C3_C11_C13_scalar_expressions", """
WITH e AS (SELECT event_id, event_type, value, json_extract_string(props, '$.k') AS k_str FROM events)
SELECT event_id,
       TRY_CAST(k_str AS DOUBLE) AS k_num,
       coalesce(CAST(TRY_CAST(TRY_CAST(k_str AS DOUBLE) % 3 AS BIGINT) AS BIGINT) <> 0, NULL) AS k_flag,
       coalesce(CAST(event_type AS VARCHAR), '<null>') || '|' || coalesce(CAST(TRY_CAST(k_str AS BIGINT) % 2 AS VARCHAR), '<null>') AS stratum,
       round(value - TRY_CAST(k_str AS DOUBLE) / 10, 8) AS residual,
       round(abs(value - TRY_CAST(k_str AS DOUBLE) / 10), 8) AS abs_error,
       round(abs((value - TRY_CAST(k_str AS DOUBLE) / 10) / (value + 1e-8)) * 100, 8) AS ape
FROM e
""")
def c_exprs(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.select(
        "event_id", "event_type", "value", F.get_json_object("props", "$.k").alias("k_str"))
    x = coerce_numeric(ev.withColumn("k_num", F.col("k_str")), ["k_num"])
    x = x.withColumn("k_mod", (F.col("k_num") % 3).cast("string")).withColumn("k_flag", lenient_bool("k_mod"))
    x = x.withColumn("k_par", (F.col("k_num").cast("long") % 2))
    x = x.withColumn("stratum", strata_key(["event_type", "k_par"]))
    res = residuals("value", F.col("k_num") / 10)
    return x.select("event_id", "k_num", "k_flag", "stratum",
                    r8(res["residual"]).alias("residual"), r8(res["abs_error"]).alias("abs_error"),
                    r8(res["ape"]).alias("ape"))


@register("C1_C4_C6_C7_C10_C16_C19_casts_and_units", """
SELECT event_id,
       epoch_us(ts) * 1000 AS t_ns,
       (epoch_us(ts) * 1000 + event_id % 1000) // 1000 AS t_us_back,
       CAST(CAST(event_type = 'purchase' AS INTEGER) AS DOUBLE) AS is_purchase,
       round(value / 1000, 8) AS value_k,
       round_even(value / 3, 2) AS third_half_even,
       CAST(user_id AS BIGINT) AS user_key,
       CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS treated
FROM events
""")
def c_casts(spark, sf_dir):
    from ..functions.expr import (bool_to_double, ns_to_timestamp, round_half_even, to_ns_ticks,
                                  treatment_indicator, unit_scale)
    ev = Tables(spark, sf_dir).events
    x = to_ns_ticks(ev.select("event_id", "ts", "user_id", "event_type", "value"), "ts")
    x = x.withColumn("is_purchase", F.col("event_type") == "purchase")
    x = bool_to_double(x)
    return x.select("event_id", F.col("ts").alias("t_ns"),
                    F.unix_micros(ns_to_timestamp(F.col("ts") + F.col("event_id") % 1000)).alias("t_us_back"), "is_purchase",
                    r8(unit_scale("value", 1000)).alias("value_k"),
                    round_half_even(F.col("value") / 3, 2).alias("third_half_even"),
                    F.col("user_id").cast("bigint").alias("user_key"),
                    treatment_indicator(F.when(F.col("event_type") == "purchase", F.lit(1))).alias("treated"))


@register("P4_P5_C12_A13_numeric_correlations_with_nulls", "WITH e AS (" + __import__(
    "tickwise.plans.q_joins", fromlist=["_NEAREST_SQL"])._NEAREST_SQL + ")\n" + _union([
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) AS r FROM e"
        for a, b in [("value", "err_value"), ("value", "gap_us"), ("err_value", "gap_us")]]))
def p4(spark, sf_dir):
    """Numeric columns chosen by type with ``*_id`` and time columns dropped,
    then pairwise-complete Pearson correlations (null matches are skipped
    pair by pair) on the as-of enriched events."""
    from ..functions.expr import numeric_columns
    from .q_joins import nearest_error
    x = nearest_error(spark, sf_dir)
    cols = numeric_columns(x, extra_drop=("t_us",))
    return round_doubles(S.corr_pairs(x, cols))


@register("C18_derived_ratio_flag_features", """
WITH c AS (SELECT user_id, count(*) AS rows_per_user_id FROM events GROUP BY user_id),
e AS (SELECT event_id, user_id, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
             ['Low', 'Medium', 'High', 'Critical'][CAST(user_id % 4 AS INTEGER) + 1] AS severity_level
      FROM events)
SELECT e.event_id, round(CASE WHEN k <> 0 THEN value / k END, 8) AS value_per_k, round(value * k, 8) AS value_x_k,
       CAST(severity_level IN ('High', 'Critical') AS INTEGER) AS is_high_severity, c.rows_per_user_id
FROM e JOIN c USING (user_id)
""")
def c18(spark, sf_dir):
    from ..functions.expr import derived_features
    from .q_causal import SEVERITIES
    ev = Tables(spark, sf_dir).events.select(
        "event_id", "user_id", "value", F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.element_at(F.array(*map(F.lit, SEVERITIES)), F.pmod(F.col("user_id"), F.lit(4)).cast("int") + 1)
        .alias("severity_level"))
    x = derived_features(ev, ratio=("value", "k"), product=("value", "k"), severity_col="severity_level",
                         key="user_id")
    return round_doubles(x.select("event_id", "value_per_k", "value_x_k", "is_high_severity", "rows_per_user_id"))
