"""Evaluation queries on deterministic stand-in predictions.

Regression: y = l_extendedprice, prediction = l_quantity * p_retailprice.
Classification: y = (l_discount >= 0.05), score = 10 * l_tax (many ties),
flag = score >= 0.5. Slices: l_returnflag.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expr import prob_flag, residuals
from ..operators import evaluate as E
from ..operators import stats as S
from ..sources.tables import Tables
from .registry import histogram_sql, register, round_doubles


def preds(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice"), "l_partkey")
    return li.select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag",
                     F.col("l_extendedprice").alias("y"),
                     (F.col("l_quantity") * F.col("p_retailprice")).alias("p"),
                     (F.col("l_discount") >= 0.05).cast("int").alias("y_cls"),
                     (F.col("l_tax") * 10).alias("score"))


PRED_SQL = """p AS (SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_returnflag, l.l_extendedprice AS y,
                  l.l_quantity * pt.p_retailprice AS p, CAST(l.l_discount >= 0.05 AS INTEGER) AS y_cls,
                  l.l_tax * 10 AS score
           FROM lineitem l JOIN part pt ON l.l_partkey = pt.p_partkey)"""


def _reg_sql(by: str) -> str:
    return f"""WITH {PRED_SQL}
SELECT {by + ', ' if by else ''}count(*) AS n, round(avg(abs(y - p)), 8) AS mae, round(sqrt(avg((y - p) * (y - p))), 8) AS rmse,
       round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)), 8) AS r2,
       round(avg(abs((y - p) / (y + 1e-8))) * 100, 8) AS mape
FROM p {'GROUP BY ' + by if by else ''}"""


@register("E1_regression_metrics", _reg_sql(""))
def e1(spark, sf_dir):
    return round_doubles(E.regression_metrics(preds(spark, sf_dir), "y", "p"))


@register("E9_E1_regression_metrics_by_slice", _reg_sql("l_returnflag"))
def e9(spark, sf_dir):
    return round_doubles(E.regression_metrics(preds(spark, sf_dir), "y", "p", by=["l_returnflag"]))


@register("E2_E9_classification_metrics_by_slice", f"""WITH {PRED_SQL},
c AS (SELECT l_returnflag, count(*) AS n,
             sum(CASE WHEN y_cls = 1 AND score >= 0.5 THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN y_cls = 0 AND score >= 0.5 THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN y_cls = 1 AND score < 0.5 THEN 1 ELSE 0 END) AS fn,
             sum(CASE WHEN y_cls = 0 AND score < 0.5 THEN 1 ELSE 0 END) AS tn FROM p GROUP BY l_returnflag)
SELECT l_returnflag, n, round((tp + tn) / n, 8) AS accuracy,
       round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 8) AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 8) AS recall,
       round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 8) AS f1
FROM c
""")
def e2(spark, sf_dir):
    x = preds(spark, sf_dir)
    return round_doubles(E.classification_metrics(x, "y_cls", prob_flag("score"), by=["l_returnflag"]))


@register("E3_E4_roc_auc_avg_precision_by_slice", f"""WITH {PRED_SQL},
g AS (SELECT l_returnflag, score, sum(y_cls) AS pos, sum(1 - y_cls) AS neg FROM p GROUP BY ALL),
c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
             sum(pos) OVER (PARTITION BY l_returnflag) AS n_pos, sum(neg) OVER (PARTITION BY l_returnflag) AS n_neg
      FROM g WINDOW w AS (PARTITION BY l_returnflag ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT l_returnflag,
       round(sum(pos * ((n_neg - fp) + 0.5 * neg)) / (any_value(n_pos) * any_value(n_neg)), 8) AS roc_auc,
       round(sum(pos * tp / (tp + fp)) / any_value(n_pos), 8) AS avg_precision
FROM c GROUP BY l_returnflag
""")
def e3(spark, sf_dir):
    return round_doubles(E.rank_metrics(preds(spark, sf_dir), "y_cls", "score", by=["l_returnflag"]))


@register("E14_roc_pr_curve_points", f"""WITH {PRED_SQL},
g AS (SELECT score, sum(y_cls) AS pos, sum(1 - y_cls) AS neg FROM p GROUP BY score),
c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS n_pos, sum(neg) OVER () AS n_neg
      FROM g WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT round(score, 8) AS score, pos, neg, tp, fp, n_pos, n_neg, round(fp / n_neg, 8) AS fpr, round(tp / n_pos, 8) AS tpr,
       round(tp / (tp + fp), 8) AS precision, round(tp / n_pos, 8) AS recall
FROM c
""")
def e14(spark, sf_dir):
    return round_doubles(E.score_table(preds(spark, sf_dir), "y_cls", "score"))


@register("E5_log_loss", f"""WITH {PRED_SQL}
SELECT round(avg(-(y_cls * ln(least(greatest(score, {E.EPS!r}), 1 - {E.EPS!r}))
                   + (1 - y_cls) * ln(1 - least(greatest(score, {E.EPS!r}), 1 - {E.EPS!r})))), 8) AS log_loss
FROM p
""")
def e5(spark, sf_dir):
    return round_doubles(E.log_loss(preds(spark, sf_dir), "y_cls", "score"))


@register("E6_confusion_matrix", f"""WITH {PRED_SQL},
g AS (SELECT y_cls AS y_true, CAST(score >= 0.5 AS INTEGER) AS y_pred, count(*) AS count FROM p GROUP BY ALL)
SELECT y_true, y_pred, count, round(count / sum(count) OVER (PARTITION BY y_true), 8) AS share FROM g
""")
def e6(spark, sf_dir):
    return round_doubles(E.confusion(preds(spark, sf_dir), "y_cls", prob_flag("score")))


@register("E7_calibration_curve", f"""WITH {PRED_SQL}
SELECT CAST((SELECT count(*) FROM range(1, 10) AS e(i) WHERE p.score > e.i * CAST(0.1 AS DOUBLE)) AS INTEGER) AS bin, count(*) AS n, round(avg(score), 8) AS prob_pred,
       round(avg(CAST(y_cls AS DOUBLE)), 8) AS prob_true
FROM p WHERE score IS NOT NULL GROUP BY 1
""")
def e7(spark, sf_dir):
    return round_doubles(E.calibration(preds(spark, sf_dir), "y_cls", "score"))


@register("E8_C13_residual_histogram_by_class", f"""WITH {PRED_SQL},
x AS (SELECT y_cls, y - p AS residual FROM p),
{histogram_sql("x", "residual", 40, "y_cls")}""")
def e8(spark, sf_dir):
    x = preds(spark, sf_dir).withColumn("residual", residuals("y", "p")["residual"])
    return round_doubles(S.histogram(x, "residual", 40, by=["y_cls"]))


@register("E8_absolute_error_histogram", f"""WITH {PRED_SQL},
x AS (SELECT abs(y - p) AS error FROM p),
{histogram_sql("x", "error", 40)}""")
def e8_error(spark, sf_dir):
    return round_doubles(S.histogram(preds(spark, sf_dir).withColumn("error", F.abs(F.col("y") - F.col("p"))), "error", 40))


@register("E8_probability_histogram_by_class", f"""WITH {PRED_SQL},
x AS (SELECT y_cls, score FROM p),
{histogram_sql("x", "score", 20, "y_cls")}""")
def e8_probability(spark, sf_dir):
    return round_doubles(S.histogram(preds(spark, sf_dir), "score", 20, by=["y_cls"]))


@register("E12_per_supplier_metrics_top10", f"""WITH {PRED_SQL},
top AS (SELECT l_suppkey, sum(y_cls) AS n_violations FROM p WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey
        ORDER BY n_violations DESC, l_suppkey LIMIT 10),
x AS (SELECT p.* FROM p JOIN top USING (l_suppkey)),
reg AS (SELECT l_suppkey, count(*) AS n, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse,
               1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)) AS r2, avg(abs((y - p) / (y + 1e-8))) * 100 AS mape,
               sum(CASE WHEN y_cls = 1 AND score >= 0.5 THEN 1 ELSE 0 END) AS tp,
               sum(CASE WHEN y_cls = 0 AND score >= 0.5 THEN 1 ELSE 0 END) AS fp,
               sum(CASE WHEN y_cls = 1 AND score < 0.5 THEN 1 ELSE 0 END) AS fn,
               sum(CASE WHEN y_cls = 0 AND score < 0.5 THEN 1 ELSE 0 END) AS tn
        FROM x GROUP BY l_suppkey),
g AS (SELECT l_suppkey, score, sum(y_cls) AS pos, sum(1 - y_cls) AS neg FROM x GROUP BY ALL),
c AS (SELECT *, sum(pos) OVER w AS tpc, sum(neg) OVER w AS fpc,
             sum(pos) OVER (PARTITION BY l_suppkey) AS n_pos, sum(neg) OVER (PARTITION BY l_suppkey) AS n_neg
      FROM g WINDOW w AS (PARTITION BY l_suppkey ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
rk AS (SELECT l_suppkey,
              CASE WHEN any_value(n_pos) = 0 OR any_value(n_neg) = 0 THEN NULL
                   ELSE sum(pos * ((n_neg - fpc) + 0.5 * neg)) / (any_value(n_pos) * any_value(n_neg)) END AS roc_auc,
              CASE WHEN any_value(n_pos) = 0 OR any_value(n_neg) = 0 THEN NULL
                   ELSE sum(pos * tpc / (tpc + fpc)) / any_value(n_pos) END AS avg_precision
       FROM c GROUP BY l_suppkey)
SELECT reg.l_suppkey, n, round(mae, 8) AS mae, round(rmse, 8) AS rmse, round(r2, 8) AS r2, round(mape, 8) AS mape,
       round((tp + tn) / n, 8) AS accuracy,
       round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 8) AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 8) AS recall,
       round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 8) AS f1,
       round(roc_auc, 8) AS roc_auc, round(avg_precision, 8) AS avg_precision, top.n_violations
FROM reg JOIN rk USING (l_suppkey) JOIN top USING (l_suppkey) WHERE n >= 2
""")
def e12(spark, sf_dir):
    x = preds(spark, sf_dir)
    return round_doubles(E.per_key_metrics_topk(x, "l_suppkey", "y", "p", "y_cls", "score",
                                                prob_flag("score"), k=10))
