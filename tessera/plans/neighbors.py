"""Exact k nearest neighbours on ``embeddings``.

Train/test split by H(vec_id:42) (75 % train). Oracles are brute force over all
pairs in SQL.
"""

from pyspark.sql import functions as F

from tessera.functions.hashing import portable_hash
from tessera.operators import neighbors as N
from tessera.plans.registry import query

K = 5


def split(t):
    e = t.embeddings
    u = portable_hash("vec_id", seed=42) % 1000000
    return e.where(u < 750000), e.where(u >= 750000)


_E_SQL = """e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label,
    CAST(('0x' || substr(md5(CAST(vec_id AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) % 1000000 < 750000 AS is_train FROM embeddings),
tr AS (SELECT * FROM e WHERE is_train), te AS (SELECT * FROM e WHERE NOT is_train)"""

def _d2(a, b):
    return f"list_reduce(list_transform(range(1, len({a}) + 1), lambda i: ({a}[i] - {b}[i]) * ({a}[i] - {b}[i])), lambda x, y: x + y)"


def _search_sql(train: str, test: str, out: str, self_too: bool = False) -> str:
    """A CTE ``out(q, n, l, d2, rk)``: all rows of ``train`` ranked for each row of ``test``."""
    return f"""{out} AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY d2, n) AS rk FROM
  (SELECT a.vec_id AS q, b.vec_id AS n, b.label AS l, {_d2('a.v', 'b.v')} AS d2 FROM {test} a, {train} b{' WHERE a.vec_id <> b.vec_id' if self_too else ''}))"""


_KNN_SQL = f"WITH {_E_SQL}, "


@query("model_knn", _KNN_SQL + _search_sql("tr", "te", "r") + f""",
top AS (SELECT * FROM r WHERE rk <= {K}),
votes AS (SELECT q, l, count(*) AS c FROM top GROUP BY q, l),
pred AS (SELECT q, arg_min(l, (-c, l)) AS prediction FROM votes GROUP BY q),
nb AS (SELECT q, string_agg(CAST(n AS VARCHAR), ',' ORDER BY rk) AS neighbors FROM top GROUP BY q)
SELECT q AS vec_id, prediction, neighbors FROM pred JOIN nb USING (q)""")
def q_knn(spark, t):
    tr, te = split(t)
    nb = N.knn(tr, te, K, "vec_id", "embedding")
    pred = N.knn_vote(nb, tr, "vec_id", "label")
    names = nb.groupBy("q_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "nbr_id"))),
                                                            lambda s: s["nbr_id"].cast("string")), ",").alias("neighbors"))
    return pred.join(names, "q_id").select(F.col("q_id").alias("vec_id"), "prediction", "neighbors")


@query("model_predict_centroid", f"""WITH {_E_SQL},
c AS (SELECT list(m ORDER BY dim) AS v FROM (SELECT dim, avg(x) AS m FROM
        (SELECT unnest(v) AS x, generate_subscripts(v, 1) AS dim FROM tr) GROUP BY dim)),
d AS (SELECT tr.vec_id AS n, tr.label AS l, {_d2('c.v', 'tr.v')} AS d2 FROM c, tr),
top AS (SELECT * FROM d ORDER BY d2, n LIMIT {K})
SELECT arg_min(l, (-c, l)) AS prediction FROM (SELECT l, count(*) AS c FROM top GROUP BY l)""")
def q_centroid_predict(spark, t):
    from tessera.operators.profile import vector_centroid
    tr, _ = split(t)
    center = [r["mean"] for r in sorted(vector_centroid(tr, "embedding", []).collect(), key=lambda r: r["dim"])]  # one number per entry
    nb = N.knn_of_point(tr, center, K, "vec_id", "embedding").withColumn("q_id", F.lit(-1).cast("long"))
    return N.knn_vote(nb, tr, "vec_id", "label").select("prediction")


@query("tune_sweep", _KNN_SQL + _search_sql("tr", "te", "r") + """,
ks AS (SELECT range AS k FROM range(1, 11)),
votes AS (SELECT k, q, l, count(*) AS c FROM r, ks WHERE rk <= k GROUP BY k, q, l),
pred AS (SELECT k, q, arg_min(l, (-c, l)) AS prediction FROM votes GROUP BY k, q)
SELECT CAST(k AS INTEGER) AS k, round(avg(CAST(prediction = te.label AS DOUBLE)), 9) AS accuracy
FROM pred JOIN te ON te.vec_id = pred.q GROUP BY k""")
def q_sweep(spark, t):
    tr, te = split(t)
    s = N.knn_sweep(tr, te, list(range(1, 11)), "vec_id", "embedding", "label")
    return s.select(F.col("k").cast("int").alias("k"), F.round("accuracy", 9).alias("accuracy"))


def _minority(t):
    e = t.embeddings
    c = e.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    r = c.agg(F.min_by("label", F.struct("n", "label")).alias("minority"), F.min("n").alias("n_min"),
              F.max("n").alias("n_max")).first()  # one row
    return e.where(F.col("label") == r.minority), r.n_max - r.n_min, r.minority


def _h(expr, seed):
    return f"CAST(('0x' || substr(md5(CAST({expr} AS VARCHAR) || ':{seed}'), 1, 15)) AS BIGINT)"


_SMOTE_SQL = f"""WITH cls AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
mm AS (SELECT arg_min(label, (n, label)) AS minority, min(n) AS n_min, max(n) AS n_max FROM cls),
mi AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v, row_number() OVER (ORDER BY vec_id) - 1 AS idx
       FROM embeddings WHERE label = (SELECT minority FROM mm)),
{_search_sql('mi', 'mi', 's', True)},
have AS (SELECT q, count(*) AS n FROM s WHERE rk <= {K} GROUP BY q),
draws AS (SELECT synthetic_id, base.vec_id AS base_id, base.v AS bv, draw % have.n + 1 AS rk, u FROM
            (SELECT range AS synthetic_id, {_h('range', '0:base')} % (SELECT n_min FROM mm) AS idx, {_h('range', '0:nbr')} AS draw,
                    {_h('range', '0:u')} / 1152921504606846976.0::DOUBLE AS u FROM range((SELECT n_max - n_min FROM mm)))
          JOIN mi base USING (idx) JOIN have ON have.q = base.vec_id),
syn AS (SELECT synthetic_id, base_id, nb.vec_id AS nbr_id, u, list_transform(range(1, len(bv) + 1), lambda i: bv[i] + u * (nb.v[i] - bv[i])) AS v
        FROM draws JOIN s ON s.q = base_id AND s.rk = draws.rk JOIN mi nb ON nb.vec_id = s.n)"""


@query("balance_smote", _SMOTE_SQL + """
SELECT synthetic_id, base_id, nbr_id, round(u, 12) AS u, round(list_reduce(v, lambda x, y: x + y), 6) AS vec_sum FROM syn""")
def q_smote(spark, t):
    mino, n_new, _ = _minority(t)
    s = N.smote(mino, n_new, K, "vec_id", "embedding", seed=0)
    return s.select("synthetic_id", "base_id", "nbr_id", F.round("u", 12).alias("u"),
                    F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x), 6).alias("vec_sum"))


@query("balance_smote_enn", _SMOTE_SQL + f""",
allr AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
         UNION ALL SELECT -1 - synthetic_id, (SELECT minority FROM mm), v FROM syn),
{_search_sql('allr', 'allr', 'a', True)}
SELECT q AS vec_id, any_value(o.label) AS label FROM a JOIN allr o ON o.vec_id = q WHERE rk <= 3
GROUP BY q HAVING min(CAST(o.label = l AS INTEGER)) = 1""")
def q_smote_enn(spark, t):
    mino, n_new, minority = _minority(t)
    s = N.smote(mino, n_new, K, "vec_id", "embedding", seed=0)
    syn = s.select((-1 - F.col("synthetic_id")).alias("vec_id"), F.col("embedding"), F.lit(minority).alias("label"))
    base = t.embeddings.select("vec_id", N.as_double(F.col("embedding")).alias("embedding"), "label")
    both = base.unionByName(syn)
    return N.enn_filter(both, "vec_id", "embedding", "label", k=3).select("vec_id", "label")
