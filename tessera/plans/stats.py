"""H rows: t tests, standard errors, confidence intervals, density curve.

Statistics and degrees of freedom are exact aggregates; p-values are computed on
the one-row result. The oracles integrate the t density by Simpson's rule.
"""

from pyspark.sql import functions as F

from tessera.functions.distributions import z_for_level
from tessera.operators import stats as H
from tessera.plans.registry import query

LEVELS = [0.90, 0.95, 0.99]


def r9(c):
    return F.round(c, 9).alias(c)


def _t_sql(stats: str, columns: str, p: str, panels: int = 20_000) -> str:
    """One row of ``stats`` (with t_stat and dof) and its p-value, ``p`` of the upper tail ``up`` beyond |t|.

    The density is integrated over [0, atan(|t| / sqrt(dof))] after the substitution x = sqrt(dof) tan(a), which is cos(a)^(dof - 1).
    """
    return f"""WITH s AS ({stats}),
g AS (SELECT s.*, atan(abs(t_stat) / sqrt(dof)) / {panels} AS h, exp(lgamma((dof + 1) / 2) - lgamma(dof / 2)) / sqrt(pi()) AS c FROM s),
q AS (SELECT sum((CASE WHEN k IN (0, {panels}) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END) * pow(cos(k * h), dof - 1)) AS area FROM g, range({panels + 1}) r(k)),
u AS (SELECT g.*, greatest(0.5 - c * area * h / 3, 0) AS up FROM g, q)
SELECT {columns}, round(t_stat, 9) AS t_stat, round(dof, 9) AS dof, round({p}, 9) AS p_value FROM u"""


_WELCH_SQL = """SELECT n1, n2, (m1 - m2) / sqrt(a + b) AS t_stat, (a + b) * (a + b) / (a * a / (n1 - 1) + b * b / (n2 - 1)) AS dof FROM
  (SELECT *, v1 / n1 AS a, v2 / n2 AS b FROM (SELECT count(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS n1, avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS m1,
    var_samp(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS v1, count(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS n2,
    avg(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS m2, var_samp(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS v2 FROM orders))"""


@query("ttest_welch", _t_sql(_WELCH_SQL, "n1, n2", "2 * up"))
def q_welch(spark, t):
    r = H.welch_ttest(t.orders, "o_totalprice", "o_orderstatus", "F", "O", "two-sided")
    return r.select("n1", "n2", r9("t_stat"), r9("dof"), r9("p_value"))


@query("ttest_welch_onesided", _t_sql(_WELCH_SQL, "n1, n2", "CASE WHEN t_stat < 0 THEN up ELSE 1 - up END"))
def q_welch_less(spark, t):
    r = H.welch_ttest(t.orders, "o_totalprice", "o_orderstatus", "F", "O", "less")
    return r.select("n1", "n2", r9("t_stat"), r9("dof"), r9("p_value"))


@query("ttest_one_sample", _t_sql("SELECT count(value) AS n, (avg(value) - 55.0::DOUBLE) / (stddev_samp(value) / sqrt(count(value))) AS t_stat, CAST(count(value) - 1 AS DOUBLE) AS dof FROM events",
                                  "n", "CASE WHEN t_stat > 0 THEN up ELSE 1 - up END"))
def q_one_sample(spark, t):
    r = H.one_sample_ttest(t.events, "value", 55.0, "greater")
    return r.select("n", r9("t_stat"), r9("dof"), r9("p_value"))


@query("stat_standard_error", """
SELECT o_orderpriority, count(*) AS n, round(avg(o_totalprice), 6) AS mean, round(stddev_samp(o_totalprice) / sqrt(count(*)), 6) AS se
FROM orders GROUP BY 1""")
def q_se(spark, t):
    r = H.standard_error(t.orders, "o_totalprice", ["o_orderpriority"])
    return r.select("o_orderpriority", "n", F.round("mean", 6).alias("mean"), F.round("se", 6).alias("se"))


@query("stat_confidence_interval", "WITH s AS (SELECT count(*) AS n, avg(value) AS m, stddev_samp(value) / sqrt(count(*)) AS se FROM events) "
       + " UNION ALL ".join(f"""SELECT CAST({lv} AS DOUBLE) AS level, n, round(m, 9) AS mean, round(se, 9) AS se, round({z_for_level(lv)!r} * se, 9) AS margin,
  round(m - {z_for_level(lv)!r} * se, 9) AS lower, round(m + {z_for_level(lv)!r} * se, 9) AS upper FROM s""" for lv in LEVELS))
def q_ci(spark, t):
    r = H.confidence_intervals(t.events, "value", LEVELS)
    return r.select("level", "n", r9("mean"), r9("se"), r9("margin"), r9("lower"), r9("upper"))


@query("stat_density_curve", """
WITH s AS (SELECT min(value) AS lo, max(value) AS hi, avg(value) AS m, stddev_samp(value) AS sd, (max(value) - min(value)) / 49 AS w, count(value) AS n_all FROM events),
h AS (SELECT CAST(least(floor((value - lo) / w), 48) AS BIGINT) AS i, count(*) AS n FROM events, s WHERE value IS NOT NULL GROUP BY 1)
SELECT g.range AS i, round(lo + g.range * (hi - lo) / 49, 9) AS x,
  round(exp(-0.5 * pow((lo + g.range * (hi - lo) / 49 - m) / sd, 2)) / (sd * sqrt(2 * pi())), 12) AS density,
  CASE WHEN g.range < 49 THEN coalesce(n, 0) END AS n, CASE WHEN g.range < 49 THEN round(coalesce(n, 0) / (n_all * w), 9) END AS empirical
FROM range(50) g CROSS JOIN s LEFT JOIN h ON h.i = g.range""")
def q_density(spark, t):
    r = H.density_with_histogram(t.events, "value", 50)
    return r.select("i", F.round("x", 9).alias("x"), F.round("density", 12).alias("density"), "n", F.round("empirical", 9).alias("empirical"))
