"""Taxonomy path similarity on region > nation > customer/supplier.

Records are orders: list 1 = the order's customer node, list 2 = the
supplier nodes of its lines.
"""

from pyspark.sql import functions as F

from tessera.operators import taxonomy as TX
from tessera.plans.registry import query


def edges(t):
    def node(prefix, c):
        return F.concat(F.lit(prefix), F.col(c).cast("string"))
    return (t.customer.select(node("C:", "c_custkey").alias("child"), node("N:", "c_nationkey").alias("parent"))
            .unionByName(t.supplier.select(node("S:", "s_suppkey").alias("child"), node("N:", "s_nationkey").alias("parent")))
            .unionByName(t.nation.select(node("N:", "n_nationkey").alias("child"), node("R:", "n_regionkey").alias("parent")))
            .unionByName(t.region.select(node("R:", "r_regionkey").alias("child"), F.lit("ROOT").alias("parent"))))


def lists(t):
    o = t.orders.select(F.col("o_orderkey").alias("rec"), F.concat(F.lit("C:"), F.col("o_custkey").cast("string")).alias("item"))
    li = t.lineitem.select(F.col("l_orderkey").alias("rec"),
                           F.concat(F.lit("S:"), F.col("l_suppkey").cast("string")).alias("item"))
    return o, li


_CLOSURE_SQL = """WITH RECURSIVE edges AS (
  SELECT 'C:' || c_custkey AS child, 'N:' || c_nationkey AS parent FROM customer
  UNION ALL SELECT 'S:' || s_suppkey, 'N:' || s_nationkey FROM supplier
  UNION ALL SELECT 'N:' || n_nationkey, 'R:' || n_regionkey FROM nation
  UNION ALL SELECT 'R:' || r_regionkey, 'ROOT' FROM region),
nodes AS (SELECT child AS node FROM edges UNION SELECT parent FROM edges),
clo(node, anc, d) AS (SELECT node, node, 0 FROM nodes UNION ALL SELECT clo.node, e.parent, clo.d + 1 FROM clo JOIN edges e ON clo.anc = e.child),
l1 AS (SELECT o_orderkey AS rec, 'C:' || o_custkey AS item FROM orders),
l2 AS (SELECT DISTINCT l_orderkey AS rec, 'S:' || l_suppkey AS item FROM lineitem),
pairsim AS (SELECT a.rec, a.item AS a, b.item AS b, 1.0 / (1 + min(ca.d + cb.d)) AS sim
            FROM l1 a JOIN l2 b ON a.rec = b.rec JOIN clo ca ON ca.node = a.item JOIN clo cb ON cb.node = b.item AND cb.anc = ca.anc
            GROUP BY a.rec, a.item, b.item),
s12 AS (SELECT rec, avg(best) AS s FROM (SELECT rec, a, max(sim) AS best FROM pairsim GROUP BY rec, a) GROUP BY rec),
s21 AS (SELECT rec, avg(best) AS s FROM (SELECT rec, b, max(sim) AS best FROM pairsim GROUP BY rec, b) GROUP BY rec),
sym AS (SELECT rec, (s12.s + s21.s) / 2 AS score FROM s12 JOIN s21 USING (rec))
"""


@query("sim_path", _CLOSURE_SQL + """
SELECT l_orderkey, l_linenumber, round(1.0 / (1 + min(ca.d + cb.d)), 9) AS sim
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN clo ca ON ca.node = 'C:' || o_custkey JOIN clo cb ON cb.node = 'S:' || l_suppkey AND cb.anc = ca.anc
GROUP BY l_orderkey, l_linenumber""")
def q_sim_path(spark, t):
    clo = TX.closure(edges(t))
    li, o = t.lineitem, t.orders
    pairs = li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_linenumber", F.concat(F.lit("C:"), F.col("o_custkey").cast("string")).alias("a"),
        F.concat(F.lit("S:"), F.col("l_suppkey").cast("string")).alias("b"))
    return TX.pair_similarity(pairs, clo, ["l_orderkey", "l_linenumber"], "a", "b").withColumn("sim", F.round("sim", 9))


@query("join_pairwise_within", _CLOSURE_SQL + """
SELECT rec AS o_orderkey, b AS item, round(max(sim), 9) AS best_sim FROM pairsim GROUP BY rec, b""")
def q_pairwise_within(spark, t):
    clo = TX.closure(edges(t))
    l1, l2 = lists(t)
    r = TX.best_match(l2, l1, clo, "rec", "item")
    return r.select(F.col("rec").alias("o_orderkey"), "item", F.round("best_sim", 9).alias("best_sim"))


@query("sim_list_best_match", _CLOSURE_SQL + "SELECT rec AS o_orderkey, round(s, 9) AS score FROM s12")
def q_list_best(spark, t):
    clo = TX.closure(edges(t))
    l1, l2 = lists(t)
    r = TX.list_score(l1, l2, clo, "rec", "item")
    return r.select(F.col("rec").alias("o_orderkey"), F.round("score", 9).alias("score"))


def _sym(t):
    clo = TX.closure(edges(t))
    l1, l2 = lists(t)
    return TX.symmetric_score(l1, l2, clo, "rec", "item")


@query("sim_document_symmetric", _CLOSURE_SQL + "SELECT rec AS o_orderkey, round(score, 9) AS score FROM sym")
def q_symmetric(spark, t):
    return _sym(t).select(F.col("rec").alias("o_orderkey"), F.round("score", 9).alias("score"))


@query("sim_best_pair", _CLOSURE_SQL + """
SELECT arg_max(rec, (round(score, 9), -rec)) AS o_orderkey, round(max(score), 9) AS score FROM sym""")
def q_best_pair(spark, t):
    s = _sym(t).withColumn("score", F.round("score", 9))
    return s.agg(F.max_by("rec", F.struct("score", (-F.col("rec")).alias("t"))).alias("o_orderkey"),
                 F.max("score").alias("score"))


@query("sim_threshold_accuracy", _CLOSURE_SQL + """
SELECT count(*) AS n, round(avg(CAST((score >= 0.2) = (o_orderstatus = 'F') AS DOUBLE)), 9) AS accuracy
FROM sym JOIN orders ON rec = o_orderkey""")
def q_threshold_acc(spark, t):
    s = _sym(t).join(t.orders.select(F.col("o_orderkey").alias("rec"), "o_orderstatus"), "rec")
    ok = ((F.col("score") >= 0.2) == (F.col("o_orderstatus") == "F")).cast("double")
    return s.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(ok), 9).alias("accuracy"))
