"""P rows: projection, filters, cleaning, outliers, encoding, scaling."""

from datetime import datetime

from pyspark.sql import functions as F

from tessera.functions.hashing import portable_hash
from tessera.operators import categories as K
from tessera.operators import clean as C
from tessera.plans.registry import query

TRAIN_CUT = int(0.8 * 2 ** 32)  # H(key:42) below this -> train side


def _split(df, key, seed=42):
    h = portable_hash(key, seed=seed)
    return df.where(h < TRAIN_CUT), df.where(h >= TRAIN_CUT)


@query("proj_select", "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem")
def q_select(spark, t):
    return C.select_columns(t.lineitem, ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"])


@query("proj_drop", "SELECT * EXCLUDE (o_orderdate, o_orderpriority) FROM orders")
def q_drop(spark, t):
    return C.drop_columns(t.orders, ["o_orderdate", "o_orderpriority"])


@query("proj_slice", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def q_slice(spark, t):
    return C.slice_columns(t.customer, None, -1)


@query("proj_rename", "SELECT n_nationkey AS nation_id, n_name AS nation_name, n_regionkey FROM nation")
def q_rename(spark, t):
    return C.rename_columns(t.nation, {"n_nationkey": "nation_id", "n_name": "nation_name"})


@query("proj_cast", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, CAST(p_size AS DOUBLE) AS p_size,
       CAST(p_retailprice AS FLOAT) AS p_retailprice, TRY_CAST(p_name AS INTEGER) AS p_name
FROM part""")
def q_cast(spark, t):
    return C.cast_columns(t.part, {"p_partkey": "string", "p_size": "double", "p_retailprice": "float",
                                   "p_name": "int"}).select("p_partkey", "p_size", "p_retailprice", "p_name")


@query("proj_recode", """
SELECT o_orderkey,
       CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'other' END AS status_name,
       CAST(o_orderstatus = 'F' AS INTEGER) AS is_finished
FROM orders""")
def q_recode(spark, t):
    o = t.orders
    return o.select("o_orderkey",
                    C.recode("o_orderstatus", {"F": "finished", "O": "open"}, "other").alias("status_name"),
                    (F.col("o_orderstatus") == "F").cast("int").alias("is_finished"))


PRIORITY_LEVELS = ["5-LOW", "3-MEDIUM", "2-HIGH", "1-URGENT"]  # low -> high; others unknown


@query("proj_ordinal", """
SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '3-MEDIUM' THEN 1
       WHEN '2-HIGH' THEN 2 WHEN '1-URGENT' THEN 3 ELSE -1 END AS priority_code
FROM orders""")
def q_ordinal(spark, t):
    return t.orders.select("o_orderkey", C.ordinal("o_orderpriority", PRIORITY_LEVELS).alias("priority_code"))


@query("proj_ratio", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice / l_quantity, 9) AS unit_price,
       round(l_tax / nullif(l_discount, 0), 9) AS tax_per_discount
FROM lineitem""")
def q_ratio(spark, t):
    return t.lineitem.select("l_orderkey", "l_linenumber",
                             C.ratio("l_extendedprice", "l_quantity", 9).alias("unit_price"),
                             C.ratio("l_tax", "l_discount", 9).alias("tax_per_discount"))


@query("proj_div_guard", """
SELECT l_orderkey, l_linenumber, round(coalesce(l_extendedprice / nullif(l_discount, 0), 0), 4) AS price_per_discount
FROM lineitem""")
def q_div_guard(spark, t):
    return t.lineitem.select("l_orderkey", "l_linenumber",
                             F.round(C.guarded_ratio("l_extendedprice", "l_discount"), 4).alias("price_per_discount"))


@query("proj_conditional_assign", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 0.0 ELSE l_quantity END AS qty_adj
FROM lineitem""")
def q_cond_assign(spark, t):
    return t.lineitem.select("l_orderkey", "l_linenumber",
                             C.assign_where(F.col("l_returnflag") == "R", F.lit(0.0), "l_quantity").alias("qty_adj"))


@query("proj_concat_key", """
SELECT l_orderkey, l_linenumber, concat_ws(' ', CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS ps_key
FROM lineitem""")
def q_concat(spark, t):
    return t.lineitem.select("l_orderkey", "l_linenumber", C.concat_key(["l_partkey", "l_suppkey"]).alias("ps_key"))


@query("filter_compare", """
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem
WHERE l_quantity >= 10 AND l_quantity < 30 AND (l_returnflag = 'R' OR l_discount = 0)
  AND l_shipdate >= TIMESTAMP '1996-01-01'""")
def q_filter_compare(spark, t):
    li = t.lineitem
    cond = ((F.col("l_quantity") >= 10) & (F.col("l_quantity") < 30)
            & ((F.col("l_returnflag") == "R") | (F.col("l_discount") == 0))
            & (F.col("l_shipdate") >= F.lit(datetime(1996, 1, 1))))
    return li.where(cond).select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


@query("filter_isin", """
SELECT c_custkey, c_mktsegment, c_nationkey FROM customer
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey IN (1, 3, 5)""")
def q_isin(spark, t):
    c = t.customer
    return (c.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & F.col("c_nationkey").isin(1, 3, 5))
            .select("c_custkey", "c_mktsegment", "c_nationkey"))


def _orders_with_nulls(t):
    return t.orders.select("o_orderkey",
                           F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("st"),
                           F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("pr"),
                           F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"))


_NULLS_SQL = """(SELECT o_orderkey, nullif(o_orderstatus, 'P') AS st, nullif(o_orderpriority, '5-LOW') AS pr,
  CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders)"""


@query("filter_any_null", f"SELECT o_orderkey, st, pr FROM {_NULLS_SQL} WHERE st IS NULL OR pr IS NULL")
def q_any_null(spark, t):
    return C.filter_any_null(_orders_with_nulls(t).select("o_orderkey", "st", "pr"))


@query("clean_sentinel_null", """
SELECT s_suppkey, TRY_CAST(nullif(raw, '?') AS DOUBLE) AS s_acctbal_clean
FROM (SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN '?' ELSE CAST(s_acctbal AS VARCHAR) END AS raw FROM supplier)""")
def q_sentinel(spark, t):
    s = t.supplier.select("s_suppkey", F.when(F.col("s_acctbal") < 0, F.lit("?"))
                          .otherwise(F.col("s_acctbal").cast("string")).alias("raw"))
    return s.select("s_suppkey", F.expr("try_cast(raw AS double)").alias("_x"),
                    C.sentinel_to_null("raw", ["?"]).alias("clean")).select(
        "s_suppkey", F.expr("try_cast(clean AS double)").alias("s_acctbal_clean"))


@query("clean_dropna", f"SELECT o_orderkey, st, pr FROM {_NULLS_SQL} WHERE st IS NOT NULL")
def q_dropna(spark, t):
    return C.drop_nulls(_orders_with_nulls(t).select("o_orderkey", "st", "pr"), subset=["st"])


@query("clean_drop_null_columns", "SELECT o_orderkey FROM orders")
def q_drop_null_cols(spark, t):
    return C.drop_null_columns(_orders_with_nulls(t))


@query("clean_impute_mean", f"""
SELECT o_orderkey, round(coalesce(price, avg(price) OVER ()), 4) AS price FROM {_NULLS_SQL}""")
def q_impute(spark, t):
    out = C.impute_mean(_orders_with_nulls(t).select("o_orderkey", "price"), ["price"])
    return out.select("o_orderkey", F.round("price", 4).alias("price"))


NZV_COLS = ["l_returnflag", "l_linestatus", "l_discount", "l_tax", "l_linenumber", "big_qty", "constant"]


def _nzv_input(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_discount", "l_tax", "l_linenumber",
                             (F.col("l_quantity") > 49).cast("int").alias("big_qty"),
                             F.lit("x").alias("constant"))


_NZV_SQL_PARTS = " UNION ALL ".join(
    f"SELECT '{c}' AS col, CAST({v} AS VARCHAR) AS value FROM lineitem"
    for c, v in [("l_returnflag", "l_returnflag"), ("l_linestatus", "l_linestatus"), ("l_discount", "l_discount"),
                 ("l_tax", "l_tax"), ("l_linenumber", "l_linenumber"),
                 ("big_qty", "CAST(l_quantity > 49 AS INTEGER)"), ("constant", "'x'")])


@query("clean_near_zero_var", f"""
WITH long AS ({_NZV_SQL_PARTS}),
vc AS (SELECT col, value, count(*) AS cnt FROM long GROUP BY col, value),
r AS (SELECT col, cnt, row_number() OVER (PARTITION BY col ORDER BY cnt DESC) AS rn, count(*) OVER (PARTITION BY col) AS nu FROM vc),
s AS (SELECT col, max(CASE WHEN rn = 1 THEN cnt END) AS top1, max(CASE WHEN rn = 2 THEN cnt END) AS top2, max(nu) AS nu FROM r GROUP BY col)
SELECT col AS "column", round(CASE WHEN nu <= 1 THEN 0.0 ELSE top1 / top2 END, 6) AS freq_ratio,
       round(100.0 * nu / (SELECT count(*) FROM lineitem), 6) AS pct_unique, nu <= 1 AS zero_var,
       ((CASE WHEN nu <= 1 THEN 0.0 ELSE top1 / top2 END) > 19 AND 100.0 * nu / (SELECT count(*) FROM lineitem) <= 10) OR nu <= 1 AS nzv
FROM s""")
def q_nzv(spark, t):
    r = C.near_zero_variance(_nzv_input(t), NZV_COLS)
    return r.select("column", F.round("freq_ratio", 6).alias("freq_ratio"),
                    F.round("pct_unique", 6).alias("pct_unique"), "zero_var", "nzv")


@query("clean_duplicates", """
SELECT md5(text) AS text_md5, count(*) AS n_copies, min(doc_id) AS first_doc_id
FROM documents GROUP BY text HAVING count(*) > 1""")
def q_duplicates(spark, t):
    d = C.duplicate_groups(t.documents.select("doc_id", "text"), ["text"], first_by="doc_id")
    return d.select(F.md5("text").alias("text_md5"), "n_copies", "first_doc_id")


@query("clean_dedup_first", """
SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)""")
def q_dedup(spark, t):
    d = C.dedup_first(t.documents.select("doc_id", "text", "lang", "source"), ["text"], "doc_id")
    return d.select("doc_id", "lang", "source")


@query("outlier_fences", """
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, value, round(q1 - 1.5 * (q3 - q1), 9) AS lower, round(q3 + 1.5 * (q3 - q1), 9) AS upper
FROM events, q WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""")
def q_fences(spark, t):
    f = C.flag_outliers(t.events.select("event_id", "value"), "value", 1.5)
    return f.where("is_outlier").select("event_id", "value",
                                        F.round("lower", 9).alias("lower"), F.round("upper", 9).alias("upper"))


@query("outlier_cap_iqr", """
WITH c0 AS (SELECT c_custkey, greatest(c_acctbal, 0.0) AS bal FROM customer),
q AS (SELECT quantile_cont(bal, 0.25) AS q1, quantile_cont(bal, 0.75) AS q3 FROM c0)
SELECT c_custkey, round(least(bal, q3 + 0.5 * (q3 - q1)), 9) AS c_acctbal FROM c0, q""")
def q_cap_iqr(spark, t):
    out = C.cap_iqr(t.customer.select("c_custkey", "c_acctbal"), ["c_acctbal"], factor=0.5)
    return out.select("c_custkey", F.round("c_acctbal", 9).alias("c_acctbal"))


@query("outlier_cap_pct", """
WITH q AS (SELECT quantile_cont(l_extendedprice, 0.95) AS p, quantile_cont(l_quantity, 0.95) AS qq FROM lineitem)
SELECT l_orderkey, l_linenumber, round(least(l_extendedprice, p), 9) AS l_extendedprice,
       round(least(l_quantity, qq), 9) AS l_quantity FROM lineitem, q""")
def q_cap_pct(spark, t):
    out = C.cap_percentile(t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"),
                           ["l_extendedprice", "l_quantity"], 0.95)
    return out.select("l_orderkey", "l_linenumber", F.round("l_extendedprice", 9).alias("l_extendedprice"),
                      F.round("l_quantity", 9).alias("l_quantity"))


@query("rule_override", """
SELECT o_orderkey, round(CASE WHEN o_orderpriority = '1-URGENT' THEN 52.0 ELSE o_totalprice * 0.9 END, 9) AS pred
FROM orders""")
def q_rule(spark, t):
    o = t.orders.withColumn("pred", F.col("o_totalprice") * 0.9)
    return o.select("o_orderkey", F.round(C.rule_override("pred", F.col("o_orderpriority") == "1-URGENT", 52.0), 9)
                    .alias("pred"))


@query("encode_dummies", """
SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'N' AS INTEGER) AS l_returnflag_N,
       CAST(l_returnflag = 'R' AS INTEGER) AS l_returnflag_R, CASE WHEN k >= 0 THEN k END AS l_partkey_idx
FROM (SELECT *, dense_rank() OVER (ORDER BY l_partkey) - 2 AS k FROM lineitem)""")
def q_dummies(spark, t):
    """Dummy columns of a few known levels, and the dummy column of a key with as many levels as there are parts."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey")
    coded = K.level_index(li, "l_partkey", K.level_table(li, "l_partkey"), "__idx")
    wide = C.dummies(coded, "l_returnflag", ["A", "N", "R"], drop_first=True)
    return wide.withColumn("l_partkey_idx", F.when(F.col("__idx") > 0, F.col("__idx") - 1)).drop("l_returnflag", "l_partkey", "__idx")


@query("encode_onehot_unknown", """
WITH lev AS (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) - 2 AS idx FROM
  (SELECT DISTINCT c_mktsegment FROM customer WHERE c_nationkey < 20 AND c_mktsegment <> 'HOUSEHOLD'))
SELECT c_custkey, c_mktsegment, CAST(CASE WHEN idx >= 0 THEN idx ELSE -1 END AS INTEGER) AS hot_index, CAST((SELECT count(*) - 1 FROM lev) AS INTEGER) AS width
FROM customer LEFT JOIN lev USING (c_mktsegment) WHERE c_nationkey >= 20""")
def q_onehot(spark, t):
    c = t.customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    train = c.where((F.col("c_nationkey") < 20) & (F.col("c_mktsegment") != "HOUSEHOLD"))
    test = c.where(F.col("c_nationkey") >= 20)
    out = K.onehot(train, test, "c_mktsegment", "seg_vec", drop_first=True)
    hot = F.coalesce(F.get("seg_vec.indices", F.lit(0)), F.lit(-1)).cast("int")
    return out.select("c_custkey", "c_mktsegment", hot.alias("hot_index"), F.col("seg_vec.size").alias("width"))


_H80 = "CAST(('0x' || substr(md5(CAST({k} AS VARCHAR) || ':42'), 1, 8)) AS BIGINT)"


@query("scale_standard", f"""
WITH tr AS (SELECT * FROM customer WHERE {_H80.format(k='c_custkey')} < {TRAIN_CUT}),
st AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s FROM tr)
SELECT c_custkey, round((c_acctbal - m) / s, 6) AS c_acctbal
FROM customer, st WHERE {_H80.format(k='c_custkey')} >= {TRAIN_CUT}""")
def q_scale_std(spark, t):
    tr, te = _split(t.customer.select("c_custkey", "c_acctbal"), "c_custkey")
    out = C.standard_scale(tr, te, ["c_acctbal"])
    return out.select("c_custkey", F.round("c_acctbal", 6).alias("c_acctbal"))


@query("scale_minmax", f"""
WITH tr AS (SELECT * FROM part WHERE {_H80.format(k='p_partkey')} < {TRAIN_CUT}),
st AS (SELECT min(p_retailprice) AS a, max(p_retailprice) AS b, min(p_size) AS c, max(p_size) AS d FROM tr)
SELECT p_partkey, round((p_retailprice - a) / (b - a), 6) AS p_retailprice, round((p_size - c) / (d - c), 6) AS p_size
FROM part, st WHERE {_H80.format(k='p_partkey')} >= {TRAIN_CUT}""")
def q_scale_minmax(spark, t):
    tr, te = _split(t.part.select("p_partkey", "p_retailprice", "p_size"), "p_partkey")
    out = C.minmax_scale(tr, te, ["p_retailprice", "p_size"])
    return out.select("p_partkey", F.round("p_retailprice", 6).alias("p_retailprice"),
                      F.round("p_size", 6).alias("p_size"))


@query("feature_polynomial", """
SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size_p1, pow(p_size, 2) AS p_size_p2, pow(p_size, 3) AS p_size_p3
FROM part""")
def q_poly(spark, t):
    return C.polynomial(t.part.select("p_partkey", "p_size"), "p_size", 3).drop("p_size")
