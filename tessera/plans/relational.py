"""J, W and U rows: joins, rankings, top-k, set operations."""

from pyspark.sql import functions as F
from tessera.functions.subquery import attach_row

from tessera.functions.ordering import dense_index
from tessera.operators import relational as R
from tessera.plans.registry import query


@query("join_inner_key", """
SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""")
def q_join_inner(spark, t):
    o, c = t.orders, t.customer
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select("o_orderkey", "c_name", "c_mktsegment")


@query("join_group_mean_back", """
SELECT l_orderkey, l_linenumber, round(avg(l_extendedprice) OVER (PARTITION BY l_partkey, l_suppkey), 6) AS mean_ps
FROM lineitem""")
def q_group_mean_back(spark, t):
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    out = R.group_mean_back(li, ["l_partkey", "l_suppkey"], "l_extendedprice", "mean_ps")
    return out.select("l_orderkey", "l_linenumber", F.round("mean_ps", 6).alias("mean_ps"))


@query("join_lookup_map", """
SELECT c_custkey, n_name FROM customer LEFT JOIN nation n
ON c_nationkey = n.n_nationkey""")
def q_lookup(spark, t):
    table = t.nation.select("n_nationkey", "n_name")
    out = R.lookup(t.customer.select("c_custkey", "c_nationkey"), table, "c_nationkey", "n_nationkey", ["n_name"])
    return out.select("c_custkey", "n_name")


@query("join_align_columns", """
SELECT a.p_partkey, a.p_size, b.price_x2 FROM (SELECT p_partkey, p_size FROM part) a
JOIN (SELECT p_partkey, p_retailprice * 2 AS price_x2 FROM part) b ON a.p_partkey = b.p_partkey""")
def q_align(spark, t):
    a = t.part.select("p_partkey", "p_size")
    b = t.part.select("p_partkey", (F.col("p_retailprice") * 2).alias("price_x2"))
    return a.join(b, "p_partkey")


@query("join_semi_anti", """
SELECT c_custkey, 'with_orders' AS side FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
UNION ALL
SELECT c_custkey, 'without_orders' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def q_semi_anti(spark, t):
    c = t.customer.select("c_custkey")
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"))
    return (R.semi(c, o, ["c_custkey"]).withColumn("side", F.lit("with_orders"))
            .unionByName(R.anti(c, o, ["c_custkey"]).withColumn("side", F.lit("without_orders"))))


@query("join_cross_best", """
WITH lab AS (SELECT * FROM (VALUES (0, 'ECONOMY'), (1, 'STANDARD'), (2, 'PROMO'), (3, 'LARGE'), (4, 'SMALL')) v(pos, label)),
s AS (SELECT p_partkey, label, pos, levenshtein(p_name, lower(label)) AS dist FROM part, lab)
SELECT p_partkey, arg_min(label, dist * 10 + pos) AS best_label, min(dist)::BIGINT AS best_dist FROM s GROUP BY p_partkey""")
def q_cross_best(spark, t):
    # a fixed five-label list: scored as five column expressions, no join
    labels = ["ECONOMY", "STANDARD", "PROMO", "LARGE", "SMALL"]
    scores = F.array(*[F.struct(F.levenshtein("p_name", F.lit(lab.lower())).alias("d"), F.lit(i).alias("i"),
                                F.lit(lab).alias("label")) for i, lab in enumerate(labels)])
    best = F.array_min(scores)
    return t.part.select("p_partkey", best["label"].alias("best_label"), best["d"].cast("bigint").alias("best_dist"))


@query("join_first_match", """
WITH q AS (SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part WHERE p_size < 10),
dict AS (SELECT unnest(string_split(p_name, ' ')) AS word, p_brand AS sense, p_partkey AS rnk FROM part WHERE p_size >= 10)
SELECT p_partkey, q.word, arg_min(sense, rnk) AS sense FROM q JOIN dict ON q.word = dict.word GROUP BY p_partkey, q.word""")
def q_first_match(spark, t):
    p = t.part
    q = p.where(F.col("p_size") < 10).select("p_partkey", F.explode(F.split("p_name", " ")).alias("word")).distinct()
    d = p.where(F.col("p_size") >= 10).select(F.explode(F.split("p_name", " ")).alias("word"),
                                              F.col("p_brand").alias("sense"), F.col("p_partkey").alias("rnk"))
    return R.first_match(q, d, ["p_partkey", "word"], "word", "sense", "rnk")


@query("win_row_index", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_idx FROM orders""")
def q_row_index(spark, t):
    return R.row_index(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("win_zscore", """
SELECT event_id, round((value - avg(value) OVER ()) / stddev_pop(value) OVER (), 6) AS z,
       abs((value - avg(value) OVER ()) / stddev_pop(value) OVER ()) > 3 AS is_outlier,
       round((value - avg(value) OVER (PARTITION BY event_type)) / stddev_pop(value) OVER (PARTITION BY event_type), 6) AS z_in_type
FROM events""")
def q_zscore(spark, t):
    ev = t.events.select("event_id", "event_type", "value")
    st = ev.agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s"))  # one row
    out = R.attach_group_row(attach_row(ev, st), "event_type", {"gm": F.avg("value"), "gs": F.stddev_pop("value")})
    z = (F.col("value") - F.col("m")) / F.col("s")
    return out.select("event_id", F.round(z, 6).alias("z"), (F.abs(z) > 3).alias("is_outlier"),
                      F.round((F.col("value") - F.col("gm")) / F.col("gs"), 6).alias("z_in_type"))


@query("sort_multi", """
SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1 AS position FROM documents""")
def q_sort_multi(spark, t):
    d = t.documents.select("doc_id", (-F.col("n_chars")).alias("neg_chars"))
    return dense_index(d, ["neg_chars", "doc_id"], "position").select("doc_id", "position")


@query("topk_freq", """
SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey ORDER BY n_orders DESC, o_custkey LIMIT 10""")
def q_topk_freq(spark, t):
    c = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    return R.top_k(c, [F.col("n_orders").desc(), F.col("o_custkey").asc()], 10)


@query("topk_both_ends", """
(SELECT p_partkey, p_retailprice, 'smallest' AS side FROM part ORDER BY p_retailprice, p_partkey LIMIT 5)
UNION ALL
(SELECT p_partkey, p_retailprice, 'largest' AS side FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 5)""")
def q_both_ends(spark, t):
    return R.both_ends(t.part.select("p_partkey", "p_retailprice"), "p_retailprice", "p_partkey", 5)


@query("topk_argmin_per_key", """
SELECT o_custkey, min(o_totalprice) AS o_totalprice, arg_min(o_orderkey, (o_totalprice, o_orderkey)) AS o_orderkey
FROM orders GROUP BY o_custkey""")
def q_argmin(spark, t):
    o = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return R.argmin_per_key(o, ["o_custkey"], "o_totalprice", "o_orderkey", [])


@query("topk_longest", """
SELECT lang, arg_min(doc_id, (-length(text), doc_id)) AS doc_id, max(length(text))::BIGINT AS n FROM documents GROUP BY lang""")
def q_longest(spark, t):
    d = t.documents.select("lang", "doc_id", F.length("text").cast("bigint").alias("n"))
    return R.argmax_per_key(d, ["lang"], "n", "doc_id", []).select("lang", "doc_id", "n")


@query("topk_rank_select", """
WITH c AS (SELECT c_nationkey AS setting, avg(c_acctbal) AS a FROM customer GROUP BY 1),
s AS (SELECT s_nationkey AS setting, avg(s_acctbal) AS b FROM supplier GROUP BY 1),
sc AS (SELECT setting, a, b FROM c JOIN s USING (setting))
SELECT 'underfit' AS kind, arg_min(setting, (a, setting)) AS setting FROM sc
UNION ALL SELECT 'overfit', arg_max(setting, (a - b, -setting)) FROM sc
UNION ALL SELECT 'best', arg_max(setting, (b, -setting)) FROM sc""")
def q_rank_select(spark, t):
    c = t.customer.groupBy(F.col("c_nationkey").alias("setting")).agg(F.avg("c_acctbal").alias("a"))
    s = t.supplier.groupBy(F.col("s_nationkey").alias("setting")).agg(F.avg("s_acctbal").alias("b"))
    sc = c.join(s, "setting")
    r = sc.agg(F.min_by("setting", F.struct("a", "setting")).alias("underfit"),
               F.max_by("setting", F.struct((F.col("a") - F.col("b")).alias("g"), (-F.col("setting")).alias("t")))
               .alias("overfit"),
               F.max_by("setting", F.struct("b", (-F.col("setting")).alias("t"))).alias("best"))
    return r.unpivot([], ["underfit", "overfit", "best"], "kind", "setting")


@query("sort_head_tail", """
(SELECT o_orderkey, 'head' AS side FROM orders ORDER BY o_orderkey LIMIT 5)
UNION ALL (SELECT o_orderkey, 'tail' AS side FROM orders ORDER BY o_orderkey DESC LIMIT 5)""")
def q_head_tail(spark, t):
    o = t.orders.select("o_orderkey")
    return (R.top_k(o, [F.col("o_orderkey").asc()], 5).withColumn("side", F.lit("head"))
            .unionByName(R.top_k(o, [F.col("o_orderkey").desc()], 5).withColumn("side", F.lit("tail"))))


@query("set_union_rows", """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, 'customer' AS kind FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'supplier' FROM supplier""")
def q_union(spark, t):
    c = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                          F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
                          F.lit("customer").alias("kind"))
    s = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                          F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"),
                          F.lit("supplier").alias("kind"))
    return c.unionByName(s)


@query("set_except", """
SELECT o_orderkey, o_orderstatus FROM orders EXCEPT ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'""")
def q_except(spark, t):
    o = t.orders.select("o_orderkey", "o_orderstatus")
    return o.exceptAll(o.where(F.col("o_orderstatus") == "F"))
