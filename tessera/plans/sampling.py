"""R rows: seeded samples, splits and class balance, exactly checkable through H."""

from pyspark.sql import functions as F

from tessera.operators import sampling as S
from tessera.plans.registry import query


def H(expr, seed):
    return f"CAST(('0x' || substr(md5(CAST({expr} AS VARCHAR) || ':{seed}'), 1, 8)) AS BIGINT)"


def W(expr, seed):
    return H(expr, seed).replace("1, 8)", "1, 15)")


@query("sample_without_replacement", f"""
SELECT o_orderkey FROM orders ORDER BY {W('o_orderkey', 11)}, o_orderkey LIMIT 100""")
def q_sample_n(spark, t):
    return S.sample_n(t.orders.select("o_orderkey"), "o_orderkey", 100, seed=11)


@query("sample_with_replacement", f"""
WITH pop AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders),
d AS (SELECT range AS draw, {W('range', 7)} % (SELECT count(*) FROM orders) AS idx FROM range(500))
SELECT draw, o_orderkey FROM d JOIN pop USING (idx)""")
def q_sample_repl(spark, t):
    return S.draws_with_replacement(t.orders.select("o_orderkey"), "o_orderkey", 500, seed=7).select("draw", "o_orderkey")


_POISSON_SQL = " + ".join(f"CAST(u >= {c!r}::DOUBLE AS INTEGER)" for c in S._poisson_steps())


@query("sample_bootstrap_means", f"""
WITH pop AS (SELECT value, row_number() OVER (ORDER BY event_id) - 1 AS idx FROM events),
d AS (SELECT range // 50 AS sample, {W("CAST(range // 50 AS VARCHAR) || ':' || CAST(range % 50 AS VARCHAR)", 3)}
             % (SELECT count(*) FROM events) AS idx FROM range(200 * 50)),
p AS (SELECT sample, value, {_POISSON_SQL} AS w FROM
  (SELECT range AS sample, value, {H("CAST(event_id AS VARCHAR) || ':' || CAST(range AS VARCHAR)", 3)} / 4294967296.0::DOUBLE AS u FROM events, range(20))),
m AS (SELECT 'draws' AS variant, sample, avg(value) AS mean FROM d JOIN pop USING (idx) GROUP BY sample
      UNION ALL SELECT 'poisson', sample, sum(w * value) / sum(w) FROM p GROUP BY sample)
SELECT variant, sample, round(mean, 9) AS mean, round(avg(mean) OVER (PARTITION BY variant), 9) AS mean_of_means FROM m""")
def q_bootstrap(spark, t):
    """200 samples of 50 draws, and 20 samples as large as the table, each with the mean of its means."""
    e = t.events.select("event_id", "value")
    draws = S.mean_of_means(S.bootstrap_means(e, "event_id", "value", 200, 50, seed=3)).withColumn("variant", F.lit("draws"))
    large = S.mean_of_means(S.poisson_bootstrap_means(e, "event_id", "value", 20, seed=3)).withColumn("variant", F.lit("poisson"))
    return draws.unionByName(large).select("variant", F.col("sample").cast("bigint").alias("sample"), F.round("mean", 9).alias("mean"),
                                           F.round("mean_of_means", 9).alias("mean_of_means"))


@query("split_train_test", f"""
SELECT o_orderkey, CASE WHEN {H('o_orderkey', 42)} % 1000000 < 800000 THEN 'train' ELSE 'test' END AS split FROM orders""")
def q_split(spark, t):
    return S.hash_split(t.orders.select("o_orderkey"), "o_orderkey", [0.8, 0.2], ["train", "test"], seed=42)


_RANK = f"""(SELECT o_orderkey, o_orderstatus,
  row_number() OVER (PARTITION BY o_orderstatus ORDER BY {H('o_orderkey', 5)}, o_orderkey) - 1 AS rk,
  count(*) OVER (PARTITION BY o_orderstatus) AS nc FROM orders)"""


@query("split_stratified", f"""
SELECT o_orderkey, o_orderstatus, CASE WHEN rk < floor(nc * 0.75 + 0.5) THEN 'train' ELSE 'test' END AS split FROM {_RANK}""")
def q_stratified(spark, t):
    o = t.orders.select("o_orderkey", "o_orderstatus")
    return S.stratified_split(o, "o_orderkey", "o_orderstatus", 0.75, seed=5)


@query("split_three_way", f"""
SELECT o_orderkey, CASE WHEN {H('o_orderkey', 9)} % 1000000 < 600000 THEN 'train'
  WHEN {H('o_orderkey', 9)} % 1000000 < 800000 THEN 'validation' ELSE 'test' END AS split FROM orders""")
def q_three_way(spark, t):
    return S.hash_split(t.orders.select("o_orderkey"), "o_orderkey", [0.6, 0.2, 0.2], ["train", "validation", "test"], 9)


@query("split_kfold", f"""
SELECT o_orderkey, CAST({H('o_orderkey', 5)} % 5 AS INTEGER) AS fold, CAST(rk % 5 AS INTEGER) AS strat_fold FROM {_RANK}""")
def q_kfold(spark, t):
    o = t.orders.select("o_orderkey", "o_orderstatus")
    a = S.kfold(o, "o_orderkey", 5, seed=5)
    b = S.kfold(o, "o_orderkey", 5, seed=5, label="o_orderstatus", col="strat_fold")
    return a.join(b.select("o_orderkey", "strat_fold"), "o_orderkey").select("o_orderkey", "fold", "strat_fold")


@query("sample_first_n", f"""
SELECT o_orderkey FROM orders WHERE {H('o_orderkey', 42)} % 1000000 < 800000 ORDER BY o_orderkey LIMIT 100""")
def q_first_n(spark, t):
    s = S.hash_split(t.orders.select("o_orderkey"), "o_orderkey", [0.8, 0.2], ["train", "test"], seed=42)
    return s.where(F.col("split") == "train").orderBy("o_orderkey").limit(100).select("o_orderkey")


@query("balance_undersample", f"""
(SELECT doc_id, quality FROM labels WHERE quality = 1 ORDER BY {W('doc_id', 13)}, doc_id
 LIMIT (SELECT CAST(ceil(count(*) / 0.5) AS BIGINT) FROM labels WHERE quality <> 1))
UNION ALL SELECT doc_id, quality FROM labels WHERE quality <> 1""")
def q_undersample(spark, t):
    return S.undersample(t.labels.select("doc_id", "quality"), "doc_id", "quality", 1, 0.5, seed=13)


@query("balance_oversample", f"""
WITH mino AS (SELECT doc_id, quality, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM labels WHERE quality = 0),
d AS (SELECT {W('range', 17)} % (SELECT count(*) FROM mino) AS idx FROM range((SELECT count(*) FROM labels WHERE quality <> 0)))
SELECT doc_id, quality FROM labels WHERE quality <> 0
UNION ALL SELECT doc_id, quality FROM d JOIN mino USING (idx)""")
def q_oversample(spark, t):
    return S.oversample(t.labels.select("doc_id", "quality"), "doc_id", "quality", 0, seed=17)


@query("balance_class_weight", """
SELECT doc_id, round(n_all / (k * n), 9) AS weight FROM labels
JOIN (SELECT quality, count(*) AS n FROM labels GROUP BY 1) USING (quality),
(SELECT count(*) AS n_all, count(DISTINCT quality) AS k FROM labels)""")
def q_class_weight(spark, t):
    lab = t.labels.select("doc_id", "quality")
    w = S.class_weights(lab, "quality")
    return lab.join(w, "quality").select("doc_id", F.round("weight", 9).alias("weight"))
