"""Event-effect queries on the events stream.

Stand-ins (SURVEY §7.4): the series is every event (tick = ``ts`` in us,
outcome = ``value``); treated events are purchases; action / attack /
severity labels are derived from ``props.k`` and ``user_id``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import POISSON1_STEPS, md5_poisson1_weights
from ..operators import bootstrap as B
from ..operators import causal as K
from ..operators import stats as S
from ..session import cut_lineage, micros
from ..sources.tables import Tables
from .registry import register, round_doubles

# Fixed category domains of the reference (action, attack, severity).
ACTIONS = ["Access Control", "Isolation", "Traffic Redirection"]
ATTACKS = ["Data Injection", "DoS", "MITM", "Replay", "Spoofing"]
SEVERITIES = ["Low", "Medium", "High", "Critical"]
HALF_WIDTH = 2 * 3_600_000_000   # 2 h in us
SEED = 42


def causal_input(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    k = F.get_json_object("props", "$.k").cast("int")
    return ev.select(
        "event_id", "user_id", micros("ts").alias("t_us"), "value",
        F.when(F.col("event_type") == "purchase",
               F.element_at(F.array(*map(F.lit, ACTIONS)), F.pmod(k, F.lit(3)) + 1)).alias("action_type"),
        F.element_at(F.array(*map(F.lit, ATTACKS)), F.pmod(k, F.lit(5)) + 1).alias("attack_type"),
        F.element_at(F.array(*map(F.lit, SEVERITIES)), F.pmod(F.col("user_id"), F.lit(4)).cast("int") + 1)
        .alias("severity_level"),
        k.alias("k"))


def _lst(vals):
    return "[" + ", ".join(f"'{v}'" for v in vals) + "]"


CAUSAL_SQL = f"""
SELECT event_id, user_id, epoch_us(ts) AS t_us, value,
       CASE WHEN event_type = 'purchase'
            THEN {_lst(ACTIONS)}[CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 + 1] END AS action_type,
       {_lst(ATTACKS)}[CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 + 1] AS attack_type,
       {_lst(SEVERITIES)}[CAST(user_id % 4 AS INTEGER) + 1] AS severity_level,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events
"""


def pre_post_table(spark, sf_dir):
    ci = causal_input(spark, sf_dir)
    series = ci.select("t_us", "event_id", "value")
    treated = ci.where(F.col("action_type").isNotNull()).select(
        "event_id", "t_us", "action_type", "attack_type", "severity_level")
    return K.pre_post(series, treated, t_col="t_us", tie_col="event_id", value_col="value",
                      event_key="event_id", event_t="t_us", half_width=HALF_WIDTH,
                      attrs=["action_type", "attack_type", "severity_level"])


def _windows_sql(centres: str, sfx: str = "") -> str:
    """Rows of the series in [c - w, c + w] per centre (event_id, te), pre/post
    role, first row at/after te dropped; CTE names get suffix ``sfx``."""
    W = HALF_WIDTH
    return f"""
d{sfx} AS (SELECT event_id AS rid, epoch_us(ts) AS t, value AS lat FROM events),
j{sfx} AS (SELECT c.*, d.rid, d.t, d.lat FROM ({centres}) c JOIN d{sfx} d ON d.t BETWEEN c.te - {W} AND c.te + {W}),
cr{sfx} AS (SELECT event_id, rid AS centre_rid FROM j{sfx} WHERE t >= te
       QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY t, rid) = 1),
r{sfx} AS (SELECT j.*, CASE WHEN t < te THEN 'pre' ELSE 'post' END AS role
      FROM j{sfx} j LEFT JOIN cr{sfx} USING (event_id) WHERE t < te OR rid <> centre_rid),
s{sfx} AS (SELECT event_id, any_value(te) AS te,
             avg(lat) FILTER (WHERE role = 'pre') AS pre_mean, avg(lat) FILTER (WHERE role = 'post') AS post_mean,
             quantile_cont(lat, 0.95) FILTER (WHERE role = 'pre') AS pre_p95,
             quantile_cont(lat, 0.95) FILTER (WHERE role = 'post') AS post_p95,
             count(*) FILTER (WHERE role = 'pre') AS pre_n, count(*) FILTER (WHERE role = 'post') AS post_n
      FROM r{sfx} GROUP BY event_id HAVING pre_n >= 5 AND post_n >= 5)"""


K1_SQL = f"""
WITH ci AS ({CAUSAL_SQL}),
{_windows_sql("SELECT event_id, t_us AS te FROM ci WHERE action_type IS NOT NULL")},
p AS (SELECT r.event_id, r.t, row_number() OVER w AS rn,
             avg(lat) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS m
      FROM r WHERE role = 'post' WINDOW w AS (PARTITION BY event_id ORDER BY t, rid)),
rest AS (SELECT p.event_id, min(CASE WHEN rn >= 5 AND m <= s.pre_mean THEN p.t END) AS first_ok,
                max(p.t) AS last_t, count(*) AS np FROM p JOIN s USING (event_id) GROUP BY p.event_id),
k1 AS (SELECT s.event_id, ci.action_type, ci.attack_type, ci.severity_level, s.te AS t_us,
              s.pre_mean, s.post_mean, s.pre_p95, s.post_p95, s.pre_n, s.post_n,
              s.post_mean - s.pre_mean AS delta_mean, s.post_p95 - s.pre_p95 AS delta_p95,
              CAST(CASE WHEN np < 5 THEN NULL ELSE coalesce(first_ok, last_t) - s.te END AS DOUBLE) AS restoration_time
       FROM s JOIN ci USING (event_id) LEFT JOIN rest USING (event_id))
"""


@register("K1_J6_W6_pre_post_event_study", K1_SQL + """
SELECT event_id, action_type, attack_type, severity_level, t_us, round(pre_mean, 8) AS pre_mean,
       round(post_mean, 8) AS post_mean, round(pre_p95, 8) AS pre_p95, round(post_p95, 8) AS post_p95,
       pre_n, post_n, round(delta_mean, 8) AS delta_mean, round(delta_p95, 8) AS delta_p95,
       round(restoration_time, 8) AS restoration_time
FROM k1
""")
def k1(spark, sf_dir):
    return round_doubles(pre_post_table(spark, sf_dir))


@register("K5_rollup_by_action", K1_SQL + """
SELECT action_type, count(event_id) AS n_events, round(avg(pre_mean), 8) AS pre_mean,
       round(avg(post_mean), 8) AS post_mean, round(avg(delta_mean), 8) AS delta_mean,
       round(stddev_samp(delta_mean), 8) AS delta_mean_std, round(avg(delta_p95), 8) AS delta_p95,
       round(avg(restoration_time) / 1000, 8) AS mean_restoration
FROM k1 GROUP BY action_type
""")
def k5a(spark, sf_dir):
    r = K.rollups(pre_post_table(spark, sf_dir), event_key="event_id", action="action_type",
                  attack="attack_type", severity="severity_level")
    return round_doubles(r["by_action"])


@register("K5_A10_rollup_action_by_severity", K1_SQL + """
SELECT action_type, severity_level, count(event_id) AS n, round(avg(delta_mean), 8) AS delta_mean
FROM k1 WHERE severity_level IS NOT NULL GROUP BY action_type, severity_level
""")
def k5s(spark, sf_dir):
    r = K.rollups(pre_post_table(spark, sf_dir), event_key="event_id", action="action_type",
                  attack="attack_type", severity="severity_level")
    return round_doubles(r["by_severity"])


@register("K5_A11_heatmap_action_by_attack", K1_SQL + "SELECT action_type, " + ", ".join(
    f"round(avg(CASE WHEN attack_type = '{a}' THEN delta_mean END), 8) AS \"{a}\"" for a in ATTACKS)
    + " FROM k1 GROUP BY action_type")
def k5h(spark, sf_dir):
    r = K.rollups(pre_post_table(spark, sf_dir), event_key="event_id", action="action_type",
                  attack="attack_type", severity="severity_level")
    return round_doubles(r["heatmap"])


@register("K6_A17_best_action_per_attack", K1_SQL + """,
ba AS (SELECT action_type, attack_type, count(event_id) AS n, avg(delta_mean) AS delta_mean,
              avg(delta_p95) AS delta_p95 FROM k1 GROUP BY action_type, attack_type)
SELECT attack_type, arg_min(action_type, (delta_mean, action_type)) AS recommended_action,
       round(arg_min(delta_mean, (delta_mean, action_type)), 8) AS delta_mean,
       round(arg_min(delta_p95, (delta_mean, action_type)), 8) AS delta_p95
FROM ba GROUP BY attack_type
""")
def k6(spark, sf_dir):
    r = K.rollups(pre_post_table(spark, sf_dir), event_key="event_id", action="action_type",
                  attack="attack_type", severity="severity_level")
    return round_doubles(r["best_by_attack"])


def did_delta_table(spark, sf_dir):
    ci = causal_input(spark, sf_dir)
    series = ci.select("t_us", "event_id", "value")
    treated = ci.where(F.col("action_type").isNotNull()).select("event_id", "t_us", "action_type")
    return K.did_deltas(series, treated, t_col="t_us", tie_col="event_id", value_col="value",
                        event_key="event_id", event_t="t_us", group_col="action_type",
                        half_width=HALF_WIDTH)


def _did_sql() -> str:
    W = HALF_WIDTH
    tre = _windows_sql("SELECT event_id, t_us AS te FROM ci WHERE action_type IS NOT NULL")
    shifted = f"CASE WHEN te0 - {5 * W} < tmin THEN te0 + {5 * W} ELSE te0 - {5 * W} END"
    ctl = _windows_sql(f"""SELECT event_id, {shifted} AS te
           FROM (SELECT s.event_id, s.te AS te0 FROM s),
                (SELECT min(epoch_us(ts)) AS tmin, max(epoch_us(ts)) AS tmax FROM events)
           WHERE {shifted} <= tmax""", "2")
    return f"""
WITH ci AS ({CAUSAL_SQL}),
{tre},
{ctl.lstrip()},
deltas AS (SELECT ci.action_type, 'treated' AS arm, s.post_mean - s.pre_mean AS d FROM s JOIN ci USING (event_id)
           UNION ALL
           SELECT ci.action_type, 'control' AS arm, s2.post_mean - s2.pre_mean AS d FROM s2 JOIN ci USING (event_id)),
g AS (SELECT action_type,
             count(d) FILTER (WHERE arm = 'treated') AS n_a, avg(d) FILTER (WHERE arm = 'treated') AS mean_a,
             var_samp(d) FILTER (WHERE arm = 'treated') AS var_a,
             count(d) FILTER (WHERE arm = 'control') AS n_b, avg(d) FILTER (WHERE arm = 'control') AS mean_b,
             var_samp(d) FILTER (WHERE arm = 'control') AS var_b
      FROM deltas GROUP BY action_type)
SELECT action_type, n_a AS n_treated, n_b AS n_control, round(mean_a - mean_b, 8) AS ate_estimate,
       round((mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b), 6) AS t_stat,
       round(power(var_a / n_a + var_b / n_b, 2) / (power(var_a / n_a, 2) / (n_a - 1) + power(var_b / n_b, 2) / (n_b - 1)), 6) AS dof
FROM g WHERE n_a >= 5 AND n_b >= 5
"""


@register("K2_A19_did_point_estimates", _did_sql())
def k2_point(spark, sf_dir):
    d = did_delta_table(spark, sf_dir)
    wt = S.welch_test(d, ["action_type"], "arm", "delta_mean", "treated", "control").where(
        (F.col("n_a") >= 5) & (F.col("n_b") >= 5))
    return wt.select("action_type", F.col("n_a").alias("n_treated"), F.col("n_b").alias("n_control"),
                     F.round(F.col("mean_a") - F.col("mean_b"), 8).alias("ate_estimate"),
                     F.round("t_stat", 6).alias("t_stat"), F.round("dof", 6).alias("dof"))


@register("K2_A20_did_effects_with_ci")
def k2(spark, sf_dir):
    """DiD ATE with Poisson-bootstrap CI (2000 replicates) and Welch p."""
    return K.did_effects(did_delta_table(spark, sf_dir), event_key="event_id", group_col="action_type",
                         n_boot=2000, seed=SEED)


def psm_tables(spark, sf_dir):
    from ..operators.encode import EncoderSpec, fit_encoder
    from ..operators.models import propensity_scores
    t = Tables(spark, sf_dir)
    ci = causal_input(spark, sf_dir).join(
        t.customer.select(F.col("c_custkey").alias("user_id"), "c_acctbal", "c_nationkey"), "user_id", "left")
    ci = ci.withColumn("hour", F.hour(F.timestamp_micros("t_us"))).withColumn(
        "treated", F.col("action_type").isNotNull().cast("int"))
    cov = ["k", "hour", "c_acctbal", "c_nationkey"]
    ci = ci.dropna(subset=cov)
    enc = fit_encoder(ci, EncoderSpec(numeric=cov))
    x = enc.transform(ci, keep=["event_id", "treated", "action_type", "value"], assemble="features")
    scored = propensity_scores(x, "features", "treated", out="propensity").drop("features")
    matched = K.psm_match(scored, row_key="event_id", treat_col="treated", score_col="propensity",
                          bucket_width=0.01)
    return scored, matched


@register("K3_J8_psm_effects")
def k3(spark, sf_dir):
    """PSM: standardise covariates, L2 logistic propensity, 1-NN matching with
    replacement, paired bootstrap CI, Welch p."""
    scored, matched = psm_tables(spark, sf_dir)
    return K.psm_effects(matched, scored.where(F.col("treated") == 0), row_key="event_id",
                         group_col="action_type", outcome="value", n_boot=2000, seed=SEED)


@register("K4_U2_effect_summary")
def k4(spark, sf_dir):
    """DiD and PSM rows in one table (method, action, ate, ci, p, n)."""
    return k2(spark, sf_dir).unionByName(k3(spark, sf_dir))


@register("A22_paired_bootstrap_test")
def a22(spark, sf_dir):
    """Paired bootstrap test of MAE(a) - MAE(b) for two fixed predictors of
    ``value``: per-user mean vs per-event-type mean (2000 replicates)."""
    ev = Tables(spark, sf_dir).events.select("event_id", "user_id", "event_type", "value")
    pa = ev.groupBy("user_id").agg(F.avg("value").alias("pa"))
    pb = ev.groupBy("event_type").agg(F.avg("value").alias("pb"))
    x = ev.join(pa, "user_id").join(pb, "event_type").select(
        "event_id", F.abs(F.col("value") - F.col("pa")).alias("loss_a"),
        F.abs(F.col("value") - F.col("pb")).alias("loss_b"))
    return S.bootstrap_paired(x, [], "loss_a", "loss_b", "event_id", n_boot=2000, seed=SEED, with_p=True)


def _metric_input(spark, sf_dir):
    """Two fixed predictors of an event's value (per-user and per-type mean) and
    the class "value above 50" that they predict."""
    ev = Tables(spark, sf_dir).events.select("event_id", "user_id", "event_type", "value")
    pa = ev.groupBy("user_id").agg(F.round(F.avg("value"), 6).alias("pa"))
    pb = ev.groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("pb"))
    high = lambda c: (F.col(c) > 50).cast("int")
    return ev.join(pa, "user_id").join(pb, "event_type").select(
        "event_id", "value", "pa", "pb", high("value").alias("y"), high("pa").alias("ca"), high("pb").alias("cb"))


N_MD5 = 40
# sums and counts of one replicate's differences: observed first (weights of 1 as replicate -1)
A22_SQL = f"""
WITH pa AS (SELECT user_id, round(avg(value), 6) AS pa FROM events GROUP BY user_id),
pb AS (SELECT event_type, round(avg(value), 6) AS pb FROM events GROUP BY event_type),
x AS (SELECT event_id, value, pa, pb, CAST(value > 50 AS INT) AS y, CAST(pa > 50 AS INT) AS ca, CAST(pb > 50 AS INT) AS cb
      FROM events JOIN pa USING (user_id) JOIN pb USING (event_type)),
u AS (SELECT x.*, rep, CASE WHEN rep < 0 THEN 1 ELSE len(list_filter({POISSON1_STEPS}, lambda s: s <=
        CAST(('0x' || substr(md5(concat('{SEED}|', event_id, '|', rep)), 1, 8)) AS BIGINT))) END AS w
      FROM x, range(-1, {N_MD5}) r(rep)),
mae AS (SELECT rep, sum(w * abs(value - pa)) / sum(w) AS a, sum(w * abs(value - pb)) / sum(w) AS b FROM u GROUP BY rep),
f1 AS (SELECT rep, coalesce(2 * sum(w * y * ca) / nullif(sum(w * (y + ca)), 0), 0) AS a,
              coalesce(2 * sum(w * y * cb) / nullif(sum(w * (y + cb)), 0), 0) AS b FROM u GROUP BY rep),
s AS (SELECT rep, 'a' AS side, pa AS score, y, w FROM u UNION ALL SELECT rep, 'b', pb, y, w FROM u),
g AS (SELECT rep, side, score, sum(w * y) AS pos, sum(w * (1 - y)) AS neg FROM s GROUP BY rep, side, score),
c AS (SELECT *, sum(neg) OVER (PARTITION BY rep, side ORDER BY score) - neg AS below FROM g),
v AS (SELECT rep, side, sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) AS auc FROM c GROUP BY rep, side),
auc AS (SELECT rep, max(auc) FILTER (WHERE side = 'a') AS a, max(auc) FILTER (WHERE side = 'b') AS b FROM v GROUP BY rep),
m AS (SELECT 'mae' AS metric, * FROM mae UNION ALL SELECT 'f1', * FROM f1 UNION ALL SELECT 'auc', * FROM auc),
o AS (SELECT metric, a AS metric_a, b AS metric_b, a - b AS diff FROM m WHERE rep < 0)
SELECT metric, (SELECT count(*) FROM x) AS n, round(metric_a, 8) AS metric_a, round(metric_b, 8) AS metric_b, round(diff, 8) AS diff,
       round(quantile_cont(a - b, 0.025), 8) AS ci_lower, round(quantile_cont(a - b, 0.975), 8) AS ci_upper,
       round(avg(CASE WHEN diff <= 0 THEN CAST(a - b >= 0 AS INT) ELSE CAST(a - b <= 0 AS INT) END), 8) AS p_value
FROM m JOIN o USING (metric) WHERE rep >= 0 GROUP BY metric, metric_a, metric_b, diff
"""


@register("A22_metric_bootstrap_mae_f1_auc", A22_SQL)
def a22_metrics(spark, sf_dir):
    """Paired tests of MAE, F1 and AUC with weights that SQL can draw too."""
    x = cut_lineage(_metric_input(spark, sf_dir))
    how = {"row_key": "event_id", "n_boot": N_MD5, "seed": SEED, "weights": md5_poisson1_weights}
    rows = [("mae", B.metric_bootstrap(x, "value", ("pa", "pb"), B.MAE, **how)), ("f1", B.metric_bootstrap(x, "y", ("ca", "cb"), B.F1, **how)),
            ("auc", B.metric_bootstrap(x, "y", ("pa", "pb"), B.AUC, **how))]
    return round_doubles(reduce(DataFrame.unionAll, [d.select(F.lit(name).alias("metric"), "*") for name, d in rows]))
