"""A rows: aggregates and profiles."""

from pyspark.sql import functions as F
from tessera.functions.subquery import attach_row

from tessera.operators import profile as A
from tessera.operators.quantiles import quantiles
from tessera.plans.registry import query


def r6(c, name=None):
    return F.round(c if not isinstance(c, str) else F.col(c), 6).alias(name or (c if isinstance(c, str) else None))


@query("agg_group_mean", """
SELECT l_returnflag, l_linestatus, round(avg(l_extendedprice), 6) AS mean_price FROM lineitem GROUP BY 1, 2""")
def q_group_mean(spark, t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.avg("l_extendedprice"), 6).alias("mean_price"))


@query("agg_group_multi", """
SELECT o_orderpriority, round(avg(o_totalprice), 6) AS mean_price, round(median(o_totalprice), 6) AS median_price,
       count(*) AS n FROM orders GROUP BY 1""")
def q_group_multi(spark, t):
    o = t.orders
    base = o.groupBy("o_orderpriority").agg(F.round(F.avg("o_totalprice"), 6).alias("mean_price"),
                                            F.count(F.lit(1)).alias("n"))
    med = quantiles(o, "o_totalprice", [0.5], ["o_orderpriority"], ["median_price"])
    return base.join(med, "o_orderpriority").withColumn("median_price", F.round("median_price", 6))


@query("agg_value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def q_value_counts(spark, t):
    return A.value_counts(t.events, ["event_type"])


@query("agg_value_share", """
SELECT event_type, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS share FROM events GROUP BY 1""")
def q_value_share(spark, t):
    return A.value_counts(t.events, ["event_type"], normalize=True).withColumn("share", F.round("share", 9))


@query("agg_share_within_group", """
SELECT user_id, event_type, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY user_id), 9) AS share
FROM events GROUP BY 1, 2""")
def q_share_within(spark, t):
    return A.share_within(t.events, ["user_id"], "event_type").withColumn("share", F.round("share", 9))


@query("agg_conditional_rate", """
SELECT lang, round(avg(CAST(quality = 1 AS DOUBLE)), 9) AS quality_rate,
       round(avg(CASE WHEN toxic = 1 THEN length(text) END), 6) AS mean_chars_toxic, count(*) FILTER (WHERE toxic = 1) AS n_toxic
FROM documents JOIN labels USING (doc_id) GROUP BY lang""")
def q_cond_rate(spark, t):
    j = t.documents.join(t.labels, "doc_id")
    return j.groupBy("lang").agg(
        F.round(F.avg((F.col("quality") == 1).cast("double")), 9).alias("quality_rate"),
        F.round(F.avg(F.when(F.col("toxic") == 1, F.length("text"))), 6).alias("mean_chars_toxic"),
        F.count_if(F.col("toxic") == 1).alias("n_toxic"))


_LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LI_LONG = " UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS v FROM lineitem" for c in _LI_NUM)


@query("agg_describe_numeric", f"""
SELECT col AS "column", count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS min,
       round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50,
       round(quantile_cont(v, 0.75), 6) AS p75, max(v) AS max
FROM ({_LI_LONG}) GROUP BY col""")
def q_describe_num(spark, t):
    d = A.describe_numeric(t.lineitem, _LI_NUM)
    return d.select("column", "count", r6("mean"), r6("std"), "min", r6("p25"), r6("p50"), r6("p75"), "max")


@query("agg_describe_categorical", """
WITH long AS (SELECT 'c_mktsegment' AS col, c_mktsegment AS v FROM customer
              UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer),
vc AS (SELECT col, v, count(*) AS cnt FROM long GROUP BY 1, 2)
SELECT col AS "column", sum(cnt)::BIGINT AS count, count(*) AS "unique", arg_min(v, (-cnt, v)) AS top, max(cnt) AS freq
FROM vc GROUP BY col""")
def q_describe_cat(spark, t):
    return A.describe_categorical(t.customer, ["c_mktsegment", "c_nationkey"])


@query("agg_quantiles", """
SELECT round(quantile_cont(o_totalprice, 0.1), 6) AS q100, round(quantile_cont(o_totalprice, 0.25), 6) AS q250,
       round(quantile_cont(o_totalprice, 0.5), 6) AS q500, round(quantile_cont(o_totalprice, 0.75), 6) AS q750,
       round(quantile_cont(o_totalprice, 0.9), 6) AS q900 FROM orders""")
def q_quantiles(spark, t):
    q = quantiles(t.orders, "o_totalprice", [0.1, 0.25, 0.5, 0.75, 0.9])
    return q.select(*[r6(c) for c in q.columns])


@query("agg_moments", """
SELECT round(avg(value), 6) AS mean, round(median(value), 6) AS median, min(value) AS min, max(value) AS max,
       round(stddev_samp(value), 6) AS std FROM events""")
def q_moments(spark, t):
    ev = t.events
    m = ev.agg(F.round(F.avg("value"), 6).alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"),
               F.round(F.stddev_samp("value"), 6).alias("std"))
    med = quantiles(ev, "value", [0.5], (), ["median"]).select(r6("median"))
    return attach_row(m, med)


@query("agg_extreme_lookup", """
SELECT 'min' AS which, arg_min(c_custkey, (c_acctbal, c_custkey)) AS c_custkey, min(c_acctbal) AS c_acctbal FROM customer
UNION ALL SELECT 'max', arg_min(c_custkey, (-c_acctbal, c_custkey)), max(c_acctbal) FROM customer""")
def q_extreme(spark, t):
    c = t.customer
    r = c.agg(F.min_by("c_custkey", F.struct("c_acctbal", "c_custkey")).alias("kmin"), F.min("c_acctbal").alias("vmin"),
              F.min_by("c_custkey", F.struct((-F.col("c_acctbal")).alias("a"), "c_custkey")).alias("kmax"),
              F.max("c_acctbal").alias("vmax"))
    return (r.select(F.lit("min").alias("which"), F.col("kmin").alias("c_custkey"), F.col("vmin").alias("c_acctbal"))
            .unionByName(r.select(F.lit("max").alias("which"), F.col("kmax").alias("c_custkey"),
                                  F.col("vmax").alias("c_acctbal"))))


@query("agg_distinct_values", "SELECT DISTINCT p_brand FROM part ORDER BY p_brand LIMIT 10")
def q_distinct(spark, t):
    return t.part.select("p_brand").distinct().orderBy("p_brand").limit(10)


_NULL_SQL = """(SELECT o_orderkey, nullif(o_orderstatus, 'P') AS st, nullif(o_orderpriority, '5-LOW') AS pr,
  CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders)"""


@query("agg_null_counts", f"""
WITH x AS {_NULL_SQL}
SELECT 'o_orderkey' AS "column", count(*) FILTER (WHERE o_orderkey IS NULL) AS n_null FROM x
UNION ALL SELECT 'st', count(*) FILTER (WHERE st IS NULL) FROM x UNION ALL SELECT 'pr', count(*) FILTER (WHERE pr IS NULL) FROM x
UNION ALL SELECT 'price', count(*) FILTER (WHERE price IS NULL) FROM x
UNION ALL SELECT '__total__', count(*) FILTER (WHERE st IS NULL) + count(*) FILTER (WHERE pr IS NULL) + count(*) FILTER (WHERE price IS NULL) FROM x
UNION ALL SELECT '__rows_with_null__', count(*) FILTER (WHERE st IS NULL OR pr IS NULL OR price IS NULL) FROM x""")
def q_null_counts(spark, t):
    x = t.orders.select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("st"),
                        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("pr"),
                        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"))
    cols = x.columns
    row = x.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols],
                F.count_if(F.col("st").isNull() | F.col("pr").isNull() | F.col("price").isNull()).alias("__rows_with_null__"))
    row = row.withColumn("__total__", sum(F.col(c) for c in cols))
    return row.unpivot([], cols + ["__total__", "__rows_with_null__"], "column", "n_null")


@query("agg_corr_pair", """
SELECT 'l_quantity' AS feature, round(corr(l_quantity, l_extendedprice), 9) AS r FROM lineitem
UNION ALL SELECT 'l_discount', round(corr(l_discount, l_extendedprice), 9) FROM lineitem
UNION ALL SELECT 'l_tax', round(corr(l_tax, l_extendedprice), 9) FROM lineitem""")
def q_corr_pair(spark, t):
    feats = ["l_quantity", "l_discount", "l_tax"]
    row = t.lineitem.agg(*[F.corr(f, "l_extendedprice").alias(f) for f in feats])
    return row.unpivot([], feats, "feature", "r").withColumn("r", F.round("r", 9))


_CM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_CM_SQL = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 9) AS r FROM lineitem"
                             for a in _CM for b in _CM)


@query("agg_corr_matrix", _CM_SQL)
def q_corr_matrix(spark, t):
    return A.corr_matrix(t.lineitem, _CM).withColumn("r", F.round("r", 9))


_CL = _CM + ["l_net"]
_CL_SQL = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 9) AS r "
                             f"FROM (SELECT *, l_extendedprice * (1 - l_discount) AS l_net FROM lineitem)"
                             for a in _CL for b in _CL)


@query("agg_collinear_pairs", f"""
SELECT a, b, r, b AS drop_column FROM ({_CL_SQL}) WHERE a < b AND abs(r) >= 0.3""")
def q_collinear(spark, t):
    li = t.lineitem.withColumn("l_net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    cm = A.corr_matrix(li, _CL).withColumn("r", F.round("r", 9))
    return A.collinear_pairs(cm, 0.3)


_HIST_SQL = """WITH r AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
b AS (SELECT event_type, CAST(least(floor((value - lo) / ((hi - lo) / 10)), 9) AS INTEGER) AS bin, lo, hi FROM events, r)"""


@query("agg_histogram", f"""{_HIST_SQL}
SELECT bin, count(*) AS n, round(any_value(lo + bin * (hi - lo) / 10), 6) AS bin_lo,
       round(any_value(lo + (bin + 1) * (hi - lo) / 10), 6) AS bin_hi FROM b GROUP BY bin""")
def q_hist(spark, t):
    h = A.histogram(t.events, "value", 10)
    return h.select("bin", "n", r6("bin_lo"), r6("bin_hi"))


@query("agg_histogram_by", f"""{_HIST_SQL}
SELECT event_type, bin, count(*) AS n FROM b GROUP BY event_type, bin""")
def q_hist_by(spark, t):
    return A.histogram(t.events, "value", 10, ["event_type"]).select("event_type", "bin", "n")


@query("agg_box_stats", """
WITH q AS (SELECT o_orderpriority, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS med,
                  quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY 1),
j AS (SELECT o.o_orderpriority, o_totalprice AS v, q1, med, q3,
             o_totalprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM orders o JOIN q USING (o_orderpriority))
SELECT o_orderpriority, round(any_value(q1), 6) AS q1, round(any_value(med), 6) AS median, round(any_value(q3), 6) AS q3,
       min(CASE WHEN inside THEN v END) AS whisker_lo, max(CASE WHEN inside THEN v END) AS whisker_hi,
       count(*) FILTER (WHERE NOT inside) AS n_outliers FROM j GROUP BY 1""")
def q_box(spark, t):
    b = A.box_stats(t.orders, "o_totalprice", ["o_orderpriority"])
    return b.select("o_orderpriority", r6("q1"), r6("median"), r6("q3"), "whisker_lo", "whisker_hi", "n_outliers")


@query("agg_std_coverage", """
WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS sd FROM events)
SELECT round(avg(CAST(value BETWEEN m - sd AND m + sd AS DOUBLE)), 9) AS within_1sd,
       round(avg(CAST(value BETWEEN m - 2 * sd AND m + 2 * sd AS DOUBLE)), 9) AS within_2sd,
       round(avg(CAST(value BETWEEN m - 3 * sd AND m + 3 * sd AS DOUBLE)), 9) AS within_3sd FROM events, s""")
def q_std_cov(spark, t):
    c = A.std_coverage(t.events, "value")
    return c.select(*[F.round(x, 9).alias(x) for x in c.columns])


@query("agg_regression_line", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept FROM lineitem""")
def q_regline(spark, t):
    return t.lineitem.agg(F.round(F.regr_slope("l_extendedprice", "l_quantity"), 6).alias("slope"),
                          F.round(F.regr_intercept("l_extendedprice", "l_quantity"), 6).alias("intercept"))


def _profile_sql(table: str, columns: dict[str, bool], source: str) -> str:
    """``columns``: name and whether it is a number."""
    rows = f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {source}))"
    return " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{c}' AS \"column\", count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_null, count(DISTINCT {c}) AS n_distinct, "
        + (f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(avg({c}), 8) AS mean" if num else "NULL AS min, NULL AS max, NULL AS mean")
        + f", {rows} AS n_duplicates FROM {source}" for c, num in columns.items())


_LINES = ["l_returnflag", "l_linestatus", "l_quantity", "l_discount"]


@query("agg_profile", _profile_sql("customer", {"c_custkey": True, "c_name": False, "c_nationkey": True, "c_acctbal": True, "c_mktsegment": False}, "customer")
       + " UNION ALL " + _profile_sql("lineitem", {c: i > 1 for i, c in enumerate(_LINES)}, f"(SELECT {', '.join(_LINES)} FROM lineitem)"))
def q_profile(spark, t):
    """A table of unique rows, and columns in which most rows are duplicates."""
    both = [A.profile(d).withColumn("table", F.lit(n)) for n, d in (("customer", t.customer), ("lineitem", t.lineitem.select(*_LINES)))]
    return both[0].unionByName(both[1]).withColumn("mean", F.round("mean", 8))


@query("agg_label_centroid", """
SELECT label, dim, round(avg(x), 6) AS mean FROM
  (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings)
GROUP BY label, dim""")
def q_centroid(spark, t):
    c = A.vector_centroid(t.embeddings, "embedding", ["label"])
    return c.select("label", F.col("dim").cast("bigint").alias("dim"), r6("mean"))
