"""Encoder queries: fit on the chronological train split, transform all rows
(F1-F8, F12, J9). Orders stand in for the combined table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.encode import EncoderSpec, fit_encoder
from ..operators.order import chrono_split
from ..sources.tables import Tables
from .registry import register, round_doubles

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SPEC = EncoderSpec(numeric=["o_totalprice", "n_lines", "sum_qty"],
                   onehot=["o_orderstatus", "any_returnflag"],
                   ordinal={"o_orderpriority": PRIORITIES},
                   frequency=["o_custkey"])


def _base(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("sum_qty"),
        F.max(F.when(F.col("l_returnflag") == "R", "R").otherwise("N")).alias("any_returnflag"))
    orders = t.orders
    o = orders.join(li, orders.o_orderkey == li.l_orderkey, "left").drop("l_orderkey")
    # orders without lines have no returned line: a two-valued flag
    o = o.withColumn("any_returnflag", F.coalesce("any_returnflag", F.lit("N")))
    return chrono_split(o, ["o_orderdate", "o_orderkey"])


_BASE_SQL = """
li AS (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS sum_qty,
              max(CASE WHEN l_returnflag = 'R' THEN 'R' ELSE 'N' END) AS any_returnflag
       FROM lineitem GROUP BY l_orderkey),
o AS (SELECT o.*, li.n_lines, li.sum_qty, coalesce(li.any_returnflag, 'N') AS any_returnflag,
             row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_idx, count(*) OVER () AS n
      FROM orders o LEFT JOIN li ON o.o_orderkey = li.l_orderkey),
tr AS (SELECT * FROM o WHERE row_idx < CAST(floor(n * 0.7) AS BIGINT))"""


def _num_sql():
    parts = []
    for c in SPEC.numeric:
        parts.append(f"""m_{c} AS (SELECT quantile_cont({c}, 0.5) AS med FROM tr),
s_{c} AS (SELECT avg(coalesce({c}, med)) AS mu, stddev_pop(coalesce({c}, med)) AS sd FROM tr, m_{c})""")
    return ",\n".join(parts)


_ENC_SQL = f"""
WITH {_BASE_SQL},
{_num_sql()},
f AS (SELECT CAST(o_custkey AS VARCHAR) AS v, count(*) / sum(count(*)) OVER () AS share
      FROM tr WHERE o_custkey IS NOT NULL GROUP BY 1),
cats AS (SELECT 1)
SELECT o.o_orderkey,
""" + ",\n".join(
    [f"round((coalesce(o.{c}, m_{c}.med) - s_{c}.mu) / CASE WHEN s_{c}.sd > 0 THEN s_{c}.sd ELSE 1 END, 8) AS num__{c}"
     for c in SPEC.numeric]
    + ["CASE WHEN coalesce(o.o_orderstatus, '__MISSING__') = 'F' THEN 1.0 ELSE 0.0 END AS onehot__o_orderstatus_F",
       "CASE WHEN coalesce(o.o_orderstatus, '__MISSING__') = 'O' THEN 1.0 ELSE 0.0 END AS onehot__o_orderstatus_O",
       "CASE WHEN coalesce(o.o_orderstatus, '__MISSING__') = 'P' THEN 1.0 ELSE 0.0 END AS onehot__o_orderstatus_P",
       "CASE WHEN coalesce(o.any_returnflag, '__MISSING__') = 'R' THEN 1.0 ELSE 0.0 END AS onehot__any_returnflag_R",
       "coalesce(CAST(list_position(" + "[" + ", ".join(f"'{p}'" for p in PRIORITIES) + "]"
       + ", coalesce(o.o_orderpriority, 'Normal')) - 1 AS DOUBLE), -1.0) AS ordinal__o_orderpriority",
       "round(coalesce(f.share, 0.0), 8) AS freq__o_custkey_freq"]) + """
FROM o LEFT JOIN f ON CAST(o.o_custkey AS VARCHAR) = f.v, """ + ", ".join(
    f"m_{c}, s_{c}" for c in SPEC.numeric)


@register("F7_F12_fit_train_transform_all", _ENC_SQL)
def f7(spark, sf_dir):
    """Median impute + population-std scaling, if-binary one-hot with missing
    category, ordinal with explicit order, frequency encoding; fit on the
    first 70 % by time, applied to every order."""
    base = _base(spark, sf_dir)
    model = fit_encoder(base.where(F.col("split") == "train"), SPEC)
    return round_doubles(model.transform(base, keep=["o_orderkey"]))


@register("F6_J9_frequency_encoding", """
WITH f AS (SELECT p_brand AS v, count(*) / sum(count(*)) OVER () AS share FROM part
           WHERE p_brand IS NOT NULL GROUP BY 1)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, round(coalesce(f.share, 0.0), 8) AS freq__p_brand_freq
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey LEFT JOIN f ON p.p_brand = f.v
""")
def f6(spark, sf_dir):
    """Brand frequency fitted on all parts, applied to every line item through
    a size-checked lookup."""
    t = Tables(spark, sf_dir)
    part = t.part
    model = fit_encoder(part, EncoderSpec(frequency=["p_brand"]))
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").join(
        part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    enc = model.transform(li, keep=["l_orderkey", "l_linenumber", "l_partkey"])
    return round_doubles(enc)


@register("F8_feature_names", f"""
WITH {_BASE_SQL},
nm AS (SELECT 1 AS blk, 0 AS k, 'num__o_totalprice' AS feature WHERE (SELECT count(o_totalprice) FROM tr) > 0 UNION ALL SELECT 1 AS blk, 1 AS k, 'num__n_lines' AS feature WHERE (SELECT count(n_lines) FROM tr) > 0 UNION ALL SELECT 1 AS blk, 2 AS k, 'num__sum_qty' AS feature WHERE (SELECT count(sum_qty) FROM tr) > 0),
c2 AS (SELECT v, row_number() OVER (ORDER BY v) AS r, count(*) OVER () AS m
        FROM (SELECT DISTINCT coalesce(CAST(o_orderstatus AS VARCHAR), '__MISSING__') AS v FROM tr)),
o2 AS (SELECT 2 AS blk, r AS k, 'onehot__o_orderstatus_' || v AS feature FROM c2 WHERE NOT (m = 2 AND r = 1)),
c3 AS (SELECT v, row_number() OVER (ORDER BY v) AS r, count(*) OVER () AS m
        FROM (SELECT DISTINCT coalesce(CAST(any_returnflag AS VARCHAR), '__MISSING__') AS v FROM tr)),
o3 AS (SELECT 3 AS blk, r AS k, 'onehot__any_returnflag_' || v AS feature FROM c3 WHERE NOT (m = 2 AND r = 1)),
rest AS (SELECT 4 AS blk, 0 AS k, 'ordinal__o_orderpriority' AS feature
         UNION ALL SELECT 5 AS blk, 0 AS k, 'freq__o_custkey_freq' AS feature),
a AS (SELECT * FROM nm UNION ALL SELECT * FROM o2 UNION ALL SELECT * FROM o3 UNION ALL SELECT * FROM rest)
SELECT CAST(row_number() OVER (ORDER BY blk, k) - 1 AS INTEGER) AS position, feature FROM a
""")
def f8(spark, sf_dir):
    """Feature names of the fitted encoder, in assembly order."""
    base = _base(spark, sf_dir)
    model = fit_encoder(base.where(F.col("split") == "train"), SPEC)
    names = model.feature_names()
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "position int, feature string")
