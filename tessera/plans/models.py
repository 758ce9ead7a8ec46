"""M, G, T20-T22, P31, K3 rows: Spark ML fits on feature frames built from the
test tables. Most fits are iterative or randomised, so their keys are rows-only;
OLS, naive Bayes, topics and assembled vectors are computed in SQL as well."""

from functools import reduce

from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import portable_hash
from tessera.functions.staging import hinted, stage
from tessera.functions.subquery import attach_row
from tessera.operators import metrics as M
from tessera.operators import models as ML
from tessera.operators import term_models as TM
from tessera.operators import text as X
from tessera.operators import tuning as G
from tessera.operators.clean import standard_scale
from tessera.operators.relational import both_ends
from tessera.operators.sampling import kfold
from tessera.plans.registry import query, scratch_dir
from tessera.plans.text import VTOK, _vocab, _vocab_sql

DOC_FEATURES = ["n_chars", "n_digits", "n_non_word", "vowel_share", "upper_share"]
_LINE_FEATURES = ["l_quantity", "l_discount", "l_tax"]
LANG_MARKS = {"fr": "[éèêàçù]", "de": "[äöüß]", "es": "[ñáíóú¿¡]", "en": "[wkyh]"}


def doc_frame(t):
    """Labelled documents: quality label and five text statistics, hash split 75/25."""
    d = t.documents.join(t.labels, "doc_id")
    n = F.length("text").cast("double")
    f = d.select("doc_id", "lang", "source", F.col("quality").cast("double").alias("label"), n.alias("n_chars"),
                 F.regexp_count("text", F.lit("[0-9]")).cast("double").alias("n_digits"),
                 F.regexp_count("text", F.lit("[^a-zA-Z0-9_]")).cast("double").alias("n_non_word"),
                 (F.regexp_count("text", F.lit("[aeiou]")) / n).alias("vowel_share"),
                 (F.regexp_count("text", F.lit("[A-Z]")) / n).alias("upper_share"))
    u = portable_hash("doc_id", seed=42) % 1000000
    f = ML.assemble(f.withColumn("split", F.when(u < 750000, "train").otherwise("test")), DOC_FEATURES)
    return f.checkpoint(eager=True)  # iterative fits re-read it: compute the text statistics once


def lang_frame(t):
    """All documents: language label index and one share feature per language."""
    d = t.documents
    n = F.length("text").cast("double")
    f = d.select("doc_id", "lang", *[(F.regexp_count("text", F.lit(p)) / n).alias(f"share_{c}")
                                     for c, p in LANG_MARKS.items()])
    idx = F.array_position(F.array(*[F.lit(c) for c in ["de", "en", "es", "fr"]]), F.col("lang")) - 1
    u = portable_hash("doc_id", seed=42) % 1000000
    f = f.withColumn("label", idx.cast("double")).withColumn("split", F.when(u < 750000, "train").otherwise("test"))
    return ML.assemble(f, [f"share_{c}" for c in LANG_MARKS]).checkpoint(eager=True)


def reg_frame(t, vector=False):
    """Lines with their price ``y`` and three features, hash split 80/20, written once as fits read them in every pass.

    ``vector``: ``y``, ``split`` and the features assembled, for trees, which
    read the rows three times and then keep them, one object each, in memory.
    """
    li = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") / 100000.0).alias("y"), *_LINE_FEATURES)
    u = portable_hash(F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")),
                      seed=42) % 1000000
    f = li.withColumn("split", F.when(u < 800000, "train").otherwise("test")).drop("l_orderkey", "l_linenumber")
    return stage(ML.assemble(f, _LINE_FEATURES).drop(*_LINE_FEATURES) if vector else f, "reg-frame")


def _train_test(f):
    return f.where(F.col("split") == "train"), f.where(F.col("split") == "test")


def _binary_eval(pred, name):
    p = ML.positive_probability(pred)
    m = M.binary_metrics(p, "label", "prediction", 1.0)
    auc = M.roc_auc(p, "label", "p1", 1.0)
    return attach_row(m, auc).select(F.lit(name).alias("model"), "accuracy", "precision", "recall", "f1", "auc")


@query("model_ols", """
SELECT round(regr_slope(l_extendedprice / 100000.0, l_quantity), 6) AS coefficient,
       round(regr_intercept(l_extendedprice / 100000.0, l_quantity), 6) AS intercept FROM lineitem""")
def q_ols(spark, t):
    f = ML.assemble(reg_frame(t), ["l_quantity"])
    m = LinearRegression(featuresCol="features", labelCol="y", regParam=0.0, solver="normal").fit(f)
    return spark.createDataFrame([(float(m.coefficients[0]), float(m.intercept))], "coefficient double, intercept double") \
        .select(F.round("coefficient", 6).alias("coefficient"), F.round("intercept", 6).alias("intercept"))


LASSO = 0.001


def _soft_sql(i: int) -> str:
    """Coordinate step of the lasso: the soft-thresholded covariance with the rest of the target."""
    rest = " - ".join([f"b{i}"] + [f"a{min(i, k)}{max(i, k)} * w{k}" for k in range(3) if k != i])
    return f"sign({rest}) * greatest(abs({rest}) - {LASSO}, 0) / a{i}{i}"


_MOMENTS_SQL = f"""s AS (SELECT {", ".join(f"covar_pop({_LINE_FEATURES[a]}, {_LINE_FEATURES[b]}) AS a{a}{b}" for a in range(3) for b in range(a, 3))},
  {", ".join(f"covar_pop({c}, l_extendedprice / 100000.0::DOUBLE) AS b{i}, avg({c}) AS m{i}" for i, c in enumerate(_LINE_FEATURES))},
  avg(l_extendedprice / 100000.0::DOUBLE) AS my FROM lineitem)"""


@query("model_lasso", f"""
WITH RECURSIVE {_MOMENTS_SQL},
d AS (SELECT 0 AS step, 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2
  UNION ALL SELECT step + 1, CASE WHEN step % 3 = 0 THEN {_soft_sql(0)} ELSE w0 END, CASE WHEN step % 3 = 1 THEN {_soft_sql(1)} ELSE w1 END,
    CASE WHEN step % 3 = 2 THEN {_soft_sql(2)} ELSE w2 END FROM d, s WHERE step < 300),
w AS (SELECT d.*, s.* FROM d, s WHERE step = 300)
{" UNION ALL ".join(f"SELECT '{c}' AS feature, round(w{i}, 5) + 0.0 AS coefficient FROM w" for i, c in enumerate(_LINE_FEATURES))}
UNION ALL SELECT '(intercept)', round(my - w0 * m0 - w1 * m1 - w2 * m2, 5) + 0.0 FROM w""")
def q_lasso(spark, t):
    f = ML.assemble(reg_frame(t), _LINE_FEATURES)
    m = LinearRegression(featuresCol="features", labelCol="y", elasticNetParam=1.0, regParam=LASSO, standardization=False, tol=1e-12, maxIter=500).fit(f)
    return ML.coefficient_table(spark, _LINE_FEATURES, m.coefficients, m.intercept).withColumn("coefficient", F.round("coefficient", 5) + F.lit(0.0))


PENALTY = 0.01


def _scaled_doc_frames(t):
    """Training and test documents with features less the training mean over the training deviation, as ``z_*`` and vector ``z``."""
    tr, te = _train_test(doc_frame(t).drop("features"))
    names = [f"z_{c}" for c in DOC_FEATURES]
    out = []
    for part in (tr, te):
        scaled = standard_scale(tr, part, DOC_FEATURES)
        out.append(ML.assemble(scaled.withColumns({f"z_{c}": F.coalesce(F.col(c), F.lit(0.0)) for c in DOC_FEATURES}), names, "z"))
    return out[0], out[1], names


@query("model_logistic")
def q_logistic(spark, t):
    """No penalty, L1 and L2, with the distance of each fit from its optimum."""
    tr, te, names = _scaled_doc_frames(t)
    tr = tr.checkpoint(eager=True)
    out = None
    for name, ridge, lasso in (("logistic_none", 0.0, 0.0), ("logistic_l1", 0.0, PENALTY), ("logistic_l2", PENALTY, 0.0)):
        m = LogisticRegression(featuresCol="z", labelCol="label", regParam=ridge + lasso, elasticNetParam=1.0 if lasso else 0.0, standardization=False,
                               maxIter=300, tol=1e-10).fit(tr)
        weights = [float(w) for w in m.coefficients]
        row = attach_row(_binary_eval(m.transform(te), name), ML.logistic_optimality(tr, names, "label", weights, m.intercept, ridge, lasso))
        row = row.withColumns({"optimal": F.col("residual") < 1e-4, "n_weights": F.lit(sum(w != 0 for w in weights))}).drop("residual")
        out = row if out is None else out.unionByName(row)
    return out


@query("model_logistic_multinomial")
def q_multinomial(spark, t):
    tr, te = _train_test(lang_frame(t))
    m = LogisticRegression(featuresCol="features", labelCol="label", family="multinomial", maxIter=50).fit(tr)
    p = m.transform(te)
    return p.groupBy("lang").agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
                                 F.count(F.lit(1)).alias("n"))


@query("model_coefficients")
def q_coefficients(spark, t):
    """The smallest and largest coefficients of scaled features, also in original units and as odds ratio of one unit."""
    tr, _, _ = _scaled_doc_frames(t)
    raw = _train_test(doc_frame(t))[0]
    st = raw.agg(*[F.avg(c).alias(f"m_{c}") for c in DOC_FEATURES], *[F.stddev_pop(c).alias(f"s_{c}") for c in DOC_FEATURES]).first()  # one row
    m = LogisticRegression(featuresCol="z", labelCol="label", regParam=0.01).fit(tr)
    own, _ = ML.original_units([float(w) for w in m.coefficients], float(m.intercept), [st[f"m_{c}"] for c in DOC_FEATURES], [st[f"s_{c}"] for c in DOC_FEATURES])
    rows = [(c, float(w), o) for c, w, o in zip(DOC_FEATURES, m.coefficients, own)]
    coef = spark.createDataFrame(rows, "feature string, coefficient double, per_unit double").withColumn("odds_ratio", F.exp("per_unit"))
    return both_ends(coef, "coefficient", "feature", 2)


def _cramer_sql(k: int) -> str:
    """Coefficient ``k`` of three centred features by Cramer's rule on their covariances."""
    cell = lambda r, c: f"b{r}" if c == k else f"a{min(r, c)}{max(r, c)}"
    det = lambda f: " + ".join(f"{f(0, a)} * ({f(1, b)} * {f(2, c)} - {f(1, c)} * {f(2, b)})" for a, b, c in ((0, 1, 2), (1, 2, 0), (2, 0, 1)))
    return f"({det(cell)}) / ({det(lambda r, c: f'a{min(r, c)}{max(r, c)}')})"


@query("model_coefficients_linear", f"""
WITH {_MOMENTS_SQL},
w AS (SELECT *, {", ".join(f"{_cramer_sql(i)} AS w{i}" for i in range(3))} FROM s)
{" UNION ALL ".join(f"SELECT '{c}' AS feature, round(w{i} * sqrt(a{i}{i}), 6) AS scaled, round(w{i}, 6) AS per_unit FROM w" for i, c in enumerate(_LINE_FEATURES))}
UNION ALL SELECT '(intercept)', round(my, 6), round(my - w0 * m0 - w1 * m1 - w2 * m2, 6) FROM w""")
def q_coefficients_linear(spark, t):
    """A linear fit on scaled features: coefficients per deviation, and back in original units."""
    f = reg_frame(t).select("y", *[F.col(c).cast("double").alias(c) for c in _LINE_FEATURES])
    st = f.agg(*[F.avg(c).alias(f"m_{c}") for c in _LINE_FEATURES], *[F.stddev_pop(c).alias(f"s_{c}") for c in _LINE_FEATURES]).first()  # one row
    z = ML.assemble(standard_scale(f, f, _LINE_FEATURES), _LINE_FEATURES)
    m = LinearRegression(featuresCol="features", labelCol="y", regParam=0.0, solver="normal").fit(z)
    own, start = ML.original_units([float(w) for w in m.coefficients], float(m.intercept), [st[f"m_{c}"] for c in _LINE_FEATURES], [st[f"s_{c}"] for c in _LINE_FEATURES])
    rows = [(c, float(w), o) for c, w, o in zip(_LINE_FEATURES, m.coefficients, own)] + [("(intercept)", float(m.intercept), start)]
    return spark.createDataFrame(rows, "feature string, scaled double, per_unit double").select("feature", F.round("scaled", 6).alias("scaled"), F.round("per_unit", 6).alias("per_unit"))


@query("model_tree_classifier")
def q_tree_cls(spark, t):
    tr, te = _train_test(doc_frame(t))
    m = DecisionTreeClassifier(featuresCol="features", labelCol="label", maxDepth=4, seed=1).fit(tr)
    return _binary_eval(m.transform(te), "decision_tree")


@query("model_tree_regressor")
def q_tree_reg(spark, t):
    f = reg_frame(t, vector=True)
    m = DecisionTreeRegressor(featuresCol="features", labelCol="y", maxDepth=3).fit(f)
    return ML.tree_rules(spark, m)


@query("model_forest_classifier")
def q_forest_cls(spark, t):
    tr, te = _train_test(doc_frame(t))
    m = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=30, maxDepth=5, subsamplingRate=0.8,
                               featureSubsetStrategy="sqrt", minInstancesPerNode=2, seed=7).fit(tr)
    return _binary_eval(m.transform(te), "random_forest")


@query("model_forest_regressor")
def q_forest_reg(spark, t):
    tr, te = _train_test(reg_frame(t, vector=True))
    m = RandomForestRegressor(featuresCol="features", labelCol="y", numTrees=20, maxDepth=5, seed=7).fit(tr)
    return M.regression_metrics(m.transform(te), "y", "prediction")


@query("model_boosted_classifier")
def q_gbt_cls(spark, t):
    tr, te = _train_test(doc_frame(t))
    # scale_pos_weight -> weight column: positives weighted by negatives/positives of train
    w = tr.agg((F.count_if(F.col("label") == 0) / F.count_if(F.col("label") == 1)).alias("r"))
    trw = attach_row(tr, w).withColumn("w", F.when(F.col("label") == 1, F.col("r")).otherwise(F.lit(1.0)))
    m = GBTClassifier(featuresCol="features", labelCol="label", weightCol="w", maxDepth=3, stepSize=0.1, maxIter=20,
                      minInstancesPerNode=2, minInfoGain=0.0, subsamplingRate=0.8, seed=7).fit(trw)
    binary = _binary_eval(m.transform(te), "gbt")
    ltr, lte = _train_test(lang_frame(t))
    ovr = OneVsRest(classifier=GBTClassifier(maxDepth=2, maxIter=10, seed=7), featuresCol="features",
                    labelCol="label").fit(ltr)
    acc = ovr.transform(lte).agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"))
    return attach_row(binary, acc.withColumnRenamed("accuracy", "multiclass_accuracy"))


@query("model_boosted_regressor")
def q_gbt_reg(spark, t):
    tr, te = _train_test(reg_frame(t, vector=True))
    m = GBTRegressor(featuresCol="features", labelCol="y", maxDepth=3, maxIter=20, stepSize=0.1, seed=7).fit(tr)
    return M.regression_metrics(m.transform(te), "y", "prediction")


# ---- naive Bayes on term counts and on numbers -----------------------------------------

_SPLIT_SQL = "CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) % 1000000"
_LABELLED_SQL = f"""lab AS (SELECT d.doc_id, text, CAST(quality AS DOUBLE) AS label, {_SPLIT_SQL.replace("doc_id", "d.doc_id")} < 750000 AS is_train FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM lab),
voc AS (SELECT term FROM tok WHERE doc_id IN (SELECT doc_id FROM lab WHERE is_train) GROUP BY term HAVING count(DISTINCT doc_id) >= 2),
cnt AS (SELECT doc_id, term, count(*) AS tf FROM tok WHERE term IN (SELECT term FROM voc) GROUP BY ALL)"""
#: Scores as (doc_id, label, s0, s1) for two classes: margin, prediction and the usual figures.
_FIGURES_SQL = """m_{0} AS (SELECT label, round(s1 - s0, 6) AS margin, CASE WHEN s1 > s0 THEN 1 ELSE 0 END AS prediction FROM {0}),
c_{0} AS (SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE label <> 1 AND prediction = 1) AS fp,
  count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label <> 1 AND prediction = 0) AS tn FROM m_{0}),
a_{0} AS (SELECT avg(CASE WHEN p.margin > n.margin THEN 1.0 WHEN p.margin = n.margin THEN 0.5 ELSE 0.0 END) AS auc FROM m_{0} p JOIN m_{0} n ON p.label = 1 AND n.label <> 1),
f_{0} AS (SELECT '{1}' AS model, round((tp + tn) / (tp + fp + fn + tn), 9) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 9) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 9) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 9) AS f1, round(auc, 9) AS auc FROM c_{0}, a_{0})"""
_NUMBER_SQL = {"n_chars": "CAST(length(text) AS DOUBLE)", "n_digits": "CAST(length(regexp_replace(text, '[^0-9]', '', 'g')) AS DOUBLE)",
               "n_non_word": "CAST(length(regexp_replace(text, '[a-zA-Z0-9_]', '', 'g')) AS DOUBLE)",
               "vowel_share": "length(regexp_replace(text, '[^aeiou]', '', 'g')) / CAST(length(text) AS DOUBLE)",
               "upper_share": "length(regexp_replace(text, '[^A-Z]', '', 'g')) / CAST(length(text) AS DOUBLE)"}


def _density_sql(c):
    return " - ".join([f"p{c}"] + [f"ln(2 * pi() * v{c}_{f}) / 2 - pow({f} - m{c}_{f}, 2) / (2 * v{c}_{f})" for f in DOC_FEATURES])


def _labelled_counts(t):
    """Labelled documents with their split, and their counts on the training vocabulary."""
    u = portable_hash("doc_id", seed=42) % 1000000
    docs = t.documents.join(t.labels.select("doc_id", F.col("quality").cast("double").alias("label")), "doc_id")
    docs = docs.select("doc_id", "text", "label", F.when(u < 750000, "train").otherwise("test").alias("split"))
    tok = X.tokens(docs, ["doc_id", "split"], "text", X.VECTOR_TOKEN, lower=True)
    dt = stage(tok.groupBy("doc_id", "split", "token").agg(F.count(F.lit(1)).alias("n")), "labelled-counts")
    vocab = X.vocabulary_from_counts(dt.where("split = 'train'"), "doc_id", min_df=2)
    return docs.drop("text"), vocab, X.counts_on_vocabulary(dt, vocab, "doc_id")


def _margin_eval(scores, docs, name):
    p = TM.margin(scores, "doc_id", "label", 1.0).join(docs.select("doc_id", "label"), "doc_id")
    p = p.select("label", F.round("margin", 6).alias("p1"), (F.col("margin") > 0).cast("double").alias("prediction"))
    m = attach_row(M.binary_metrics(p, "label", "prediction", 1.0), M.roc_auc(p, "label", "p1", 1.0))
    return m.select(F.lit(name).alias("model"), *[F.round(c, 9).alias(c) for c in ("accuracy", "precision", "recall", "f1", "auc")])


@query("model_naive_bayes", f"""WITH {_LABELLED_SQL},
held AS (SELECT label, term, sum(tf) AS c FROM cnt JOIN lab USING (doc_id) WHERE is_train GROUP BY ALL),
cls AS (SELECT label, ln(n / sum(n) OVER ()) AS prior, ln(0.1::DOUBLE / (coalesce(t, 0) + 0.1::DOUBLE * (SELECT count(*) FROM voc))) AS absent
  FROM (SELECT label, count(*) AS n FROM lab WHERE is_train GROUP BY label) LEFT JOIN (SELECT label, sum(c) AS t FROM held GROUP BY label) USING (label)),
gain AS (SELECT doc_id, h.label, sum(tf * ln((c + 0.1::DOUBLE) / 0.1::DOUBLE)) AS g, FROM cnt JOIN held h USING (term) GROUP BY ALL),
len AS (SELECT doc_id, sum(tf) AS n FROM cnt GROUP BY doc_id),
mul AS (SELECT lab.doc_id, any_value(lab.label) AS label, max(prior + coalesce(n, 0) * absent + coalesce(g, 0)) FILTER (WHERE cls.label <> 1) AS s0,
    max(prior + coalesce(n, 0) * absent + coalesce(g, 0)) FILTER (WHERE cls.label = 1) AS s1
  FROM lab JOIN cls ON NOT is_train LEFT JOIN gain ON gain.doc_id = lab.doc_id AND gain.label = cls.label LEFT JOIN len ON len.doc_id = lab.doc_id GROUP BY lab.doc_id),
num AS (SELECT doc_id, label, is_train, {", ".join(f"{e} AS {c}" for c, e in _NUMBER_SQL.items())} FROM lab),
wid AS (SELECT greatest({", ".join(f"var_pop({c})" for c in DOC_FEATURES)}) * 1e-9 AS e FROM num WHERE is_train),
par AS (SELECT {", ".join(f"ln(count(*) FILTER (WHERE label = {c}) / count(*)) AS p{c}, " + ", ".join(f"avg({f}) FILTER (WHERE label = {c}) AS m{c}_{f}, var_pop({f}) FILTER (WHERE label = {c}) + (SELECT e FROM wid) AS v{c}_{f}" for f in DOC_FEATURES) for c in (0, 1))} FROM num WHERE is_train),
gau AS (SELECT doc_id, label, {_density_sql(0)} AS s0, {_density_sql(1)} AS s1 FROM num, par WHERE NOT is_train),
{_FIGURES_SQL.format("mul", "naive_bayes_multinomial")}, {_FIGURES_SQL.format("gau", "naive_bayes_gaussian")}
SELECT * FROM f_mul UNION ALL SELECT * FROM f_gau""")
def q_naive_bayes(spark, t):
    docs, vocab, counts = _labelled_counts(t)
    tr, te = _train_test(docs)
    model = TM.multinomial_fit(counts, vocab, tr, "doc_id", "label", 0.1)
    tested = counts.join(te.select("doc_id"), "doc_id", "left_semi")
    multi = _margin_eval(TM.multinomial_scores(tested, te, model, "doc_id", "label"), te, "naive_bayes_multinomial")
    dtr, dte = _train_test(doc_frame(t))
    g = TM.gaussian_fit(dtr, DOC_FEATURES, "label")
    return multi.unionByName(_margin_eval(TM.gaussian_scores(dte, g, DOC_FEATURES, "doc_id", "label"), dte, "naive_bayes_gaussian"))


@query("model_linear_svm")
def q_linear_svm(spark, t):
    tr, te = _train_test(doc_frame(t))
    sc = StandardScaler(inputCol="features", outputCol="z").fit(tr)
    m = LinearSVC(featuresCol="z", labelCol="label", regParam=0.01, maxIter=50).fit(sc.transform(tr))
    p = m.transform(sc.transform(te)).withColumn("margin", vector_to_array("rawPrediction")[1])
    return p.select("doc_id", "label", "prediction", F.round("margin", 6).alias("margin"))


@query("model_rbf_svm")
def q_rbf_svm(spark, t):
    f = doc_frame(t).drop("features")
    stats = f.where(F.col("split") == "train").agg(*[F.avg(c).alias(f"m_{c}") for c in DOC_FEATURES], *[F.stddev_pop(c).alias(f"s_{c}") for c in DOC_FEATURES])
    z = attach_row(f, stats).withColumns({f"z_{c}": (F.col(c) - F.col(f"m_{c}")) / F.col(f"s_{c}") for c in DOC_FEATURES})
    z = ML.random_fourier_features(z, [f"z_{c}" for c in DOC_FEATURES], 50, gamma=0.2, seed=3)
    z = ML.assemble(z, [f"rff_{j}" for j in range(50)])
    tr, te = _train_test(z)
    m = LinearSVC(featuresCol="features", labelCol="label", regParam=0.01, maxIter=50).fit(tr)
    p = m.transform(te)
    return M.binary_metrics(p, "label", "prediction", 1.0).withColumn("model", F.lit("rbf_svm_rff50"))


@query("model_majority_baseline", """
WITH tr AS (SELECT quality FROM labels WHERE CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) % 1000000 < 750000),
maj AS (SELECT arg_min(quality, (-cnt, quality)) AS m FROM (SELECT quality, count(*) AS cnt FROM tr GROUP BY 1))
SELECT doc_id, quality, m AS prediction FROM labels, maj
WHERE CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) % 1000000 >= 750000""")
def q_majority(spark, t):
    lab = t.labels.select("doc_id", "quality")
    u = portable_hash("doc_id", seed=42) % 1000000
    tr, te = lab.where(u < 750000), lab.where(u >= 750000)
    return ML.majority_baseline(tr, te, "quality", "prediction")


def _pipeline_frame(t):
    """Orders with a null-injected numeric column and a categorical column."""
    o = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus",
                        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 100000.0).alias("price"),
                        F.month("o_orderdate").cast("double").alias("month"))
    u = portable_hash("o_orderkey", seed=42) % 1000000
    o = o.withColumn("label", (F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).cast("double"))
    return o.withColumn("split", F.when(u < 750000, "train").otherwise("test"))


def _pipeline_stages(est):
    return [Imputer(inputCols=["price"], outputCols=["price_f"], strategy="mean"),
            StringIndexer(inputCol="o_orderstatus", outputCol="st_idx", handleInvalid="keep"),
            OneHotEncoder(inputCols=["st_idx"], outputCols=["st_vec"], handleInvalid="keep"),
            VectorAssembler(inputCols=["price_f", "month", "st_vec"], outputCol="raw"),
            StandardScaler(inputCol="raw", outputCol="features", withMean=True), est]


@query("model_pipeline")
def q_pipeline(spark, t):
    tr, te = _train_test(_pipeline_frame(t))
    pm = ML.fit_pipeline(_pipeline_stages(LogisticRegression(labelCol="label", regParam=0.01)), tr)
    return _binary_eval(pm.transform(te), "pipeline_logistic")


@query("model_feature_importance")
def q_importance(spark, t):
    tr, _ = _train_test(doc_frame(t))
    m = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=20, maxDepth=4, seed=7).fit(tr)
    return ML.importance_table(spark, ML.feature_names(tr), m.featureImportances, k=3)


@query("model_batch_score")
def q_batch_score(spark, t):
    tr, te = _train_test(lang_frame(t))
    m = LogisticRegression(featuresCol="features", labelCol="label", family="multinomial").fit(tr)
    names = spark.createDataFrame([(float(i), c) for i, c in enumerate(["de", "en", "es", "fr"])],
                                  "prediction double, predicted_lang string")
    return m.transform(te).join(names, "prediction", "left").select("doc_id", "lang", "predicted_lang")


@query("model_early_stopping")
def q_early_stop(spark, t):
    f = kfold(doc_frame(t), "doc_id", 5, seed=1).withColumn("is_val", F.col("fold") == 0)
    m = GBTClassifier(featuresCol="features", labelCol="label", maxIter=50, maxDepth=3, validationIndicatorCol="is_val",
                      validationTol=0.01, seed=7).fit(f)
    return spark.createDataFrame([(m.getNumTrees, 50)], "trees_used int, max_trees int")


# ---- tuning ---------------------------------------------------------------------------

def _folded(t, k=3):
    tr, _ = _train_test(doc_frame(t))
    return kfold(tr, "doc_id", k, seed=11)


@query("tune_cross_val_score")
def q_cv_score(spark, t):
    f = _folded(t)
    s = G.fold_scores(lambda **p: RandomForestClassifier(featuresCol="features", labelCol="label", seed=7, **p),
                      {"numTrees": 10, "maxDepth": 3}, f, "fold", 3, "label")
    return s.select("fold", "auc").unionByName(s.agg(F.lit(-1).alias("fold"), F.avg("auc").alias("auc")))


def _fold_sql(f):
    pars = ", ".join(f"ln(count(*) FILTER (WHERE label = {c}) / count(*)) AS p{c}, " + ", ".join(
        f"avg({x}) FILTER (WHERE label = {c}) AS m{c}_{x}, var_pop({x}) FILTER (WHERE label = {c}) + 1e-9 * greatest({', '.join(f'var_pop({y})' for y in DOC_FEATURES)}) AS v{c}_{x}"
        for x in DOC_FEATURES) for c in (0, 1))
    return (f"SELECT {f} AS fold, label, round(s1 - s0, 6) AS margin FROM (SELECT label, {_density_sql(0)} AS s0, {_density_sql(1)} AS s1 "
            f"FROM num, (SELECT {pars} FROM num WHERE fold <> {f}) WHERE fold = {f})")


@query("tune_cross_val_bayes", f"""
WITH num AS (SELECT d.doc_id, CAST(quality AS DOUBLE) AS label, {", ".join(f"{e} AS {c}" for c, e in _NUMBER_SQL.items())},
  CAST(('0x' || substr(md5(CAST(d.doc_id AS VARCHAR) || ':11'), 1, 8)) AS BIGINT) % 3 AS fold
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE {_SPLIT_SQL.replace("doc_id", "d.doc_id")} < 750000),
m AS ({" UNION ALL ".join(_fold_sql(f) for f in range(3))}),
a AS (SELECT p.fold, avg(CASE WHEN p.margin > n.margin THEN 1.0 WHEN p.margin = n.margin THEN 0.5 ELSE 0.0 END) AS auc FROM m p JOIN m n ON p.fold = n.fold AND p.label = 1 AND n.label <> 1 GROUP BY p.fold),
r AS (SELECT CAST(m.fold AS INTEGER) AS fold, count(*) AS n, avg(CAST((margin > 0) = (label = 1) AS DOUBLE)) AS accuracy, any_value(auc) AS auc FROM m JOIN a USING (fold) GROUP BY m.fold)
SELECT fold, n, round(accuracy, 9) AS accuracy, round(auc, 9) AS auc FROM r
UNION ALL SELECT -1, CAST(sum(n) AS BIGINT), round(avg(accuracy), 9), round(avg(auc), 9) FROM r""")
def q_cv_bayes(spark, t):
    """Gaussian naive Bayes scored on each of three folds by the fit of the other two, and the means: the whole loop, checked row by row."""
    f = stage(_folded(t), "folds")
    parts = []
    for k in range(3):
        test = f.where(F.col("fold") == k)
        scores = TM.gaussian_scores(test, TM.gaussian_fit(f.where(F.col("fold") != k), DOC_FEATURES, "label"), DOC_FEATURES, "doc_id", "label")
        p = TM.margin(scores, "doc_id", "label", 1.0).join(test.select("doc_id", "label"), "doc_id")
        parts.append(p.select(F.lit(k).alias("fold"), "label", F.round("margin", 6).alias("margin")))
    m = stage(reduce(DataFrame.unionByName, parts), "fold-margins")
    right = ((F.col("margin") > 0) == (F.col("label") == 1)).cast("double")
    r = m.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.avg(right).alias("accuracy")).join(M.roc_auc(m, "label", "margin", 1.0, by=["fold"]), "fold")
    r = stage(r.select("fold", "n", "accuracy", "auc"), "fold-scores")
    mean = r.agg(F.lit(-1).alias("fold"), F.sum("n").alias("n"), F.avg("accuracy").alias("accuracy"), F.avg("auc").alias("auc"))
    return r.unionByName(mean).select("fold", "n", F.round("accuracy", 9).alias("accuracy"), F.round("auc", 9).alias("auc"))


@query("tune_grid_search")
def q_grid_search(spark, t):
    """Mean AUC of every grid point, the best one marked, and the held-out AUC of its model refitted on all folds."""
    f = _folded(t)
    grid = G.grid_points({"maxDepth": [2, 4], "numTrees": [5, 10]})
    est = RandomForestClassifier(featuresCol="features", labelCol="label", seed=7)
    model, scores = G.cross_validate(est, grid, f, "fold", "label")
    best = max(range(len(scores)), key=lambda i: scores[i][1])
    _, test = _train_test(doc_frame(t))
    held_out = M.roc_auc(ML.positive_probability(model.bestModel.transform(test)), "label", "p1", 1.0).select(F.col("auc").alias("refit_auc"))
    rows = [(p["maxDepth"], p["numTrees"], float(s), i == best) for i, (p, s) in enumerate(scores)]
    return attach_row(spark.createDataFrame(rows, "maxDepth int, numTrees int, mean_auc double, best boolean"), held_out)


@query("tune_random_search")
def q_random_search(spark, t):
    """Three points drawn from a grid of two axes, the best one marked, as in the grid search."""
    f = _folded(t)
    grid = G.random_subset(G.grid_points({"maxDepth": [2, 3, 4, 5], "minInstancesPerNode": [1, 20]}), 3, seed=5)
    est = DecisionTreeClassifier(featuresCol="features", labelCol="label", seed=7)
    model, scores = G.cross_validate(est, grid, f, "fold", "label")
    best = max(range(len(scores)), key=lambda i: scores[i][1])
    rows = [(p["maxDepth"], p["minInstancesPerNode"], float(s), i == best) for i, (p, s) in enumerate(scores)]
    return spark.createDataFrame(rows, "maxDepth int, minInstancesPerNode int, mean_auc double, best boolean")


@query("tune_multi_metric_table")
def q_multi_metric(spark, t):
    f = _folded(t)
    out = None
    for depth in (2, 4):
        s = G.fold_scores(lambda maxDepth: DecisionTreeClassifier(featuresCol="features", labelCol="label",
                                                                  maxDepth=maxDepth, seed=7), {"maxDepth": depth},
                          f, "fold", 3, "label")
        r = s.agg(*[F.avg(c).alias(c) for c in ("accuracy", "precision", "recall", "f1", "auc")]).withColumn(
            "maxDepth", F.lit(depth))
        out = r if out is None else out.unionByName(r)
    best = out.agg(F.max_by("maxDepth", F.struct("f1", (-F.col("maxDepth")).alias("t"))).alias("best_by_f1"))
    return attach_row(out, best)


def _validation_curve(spark, t):
    f = _folded(t)
    out = None
    for depth in (1, 2, 4, 8):
        s = G.fold_scores(lambda maxDepth: DecisionTreeClassifier(featuresCol="features", labelCol="label",
                                                                  maxDepth=maxDepth, seed=7), {"maxDepth": depth},
                          f, "fold", 3, "label", with_train=True)
        r = s.groupBy("side").agg(F.avg("accuracy").alias("mean"), F.stddev_pop("accuracy").alias("std")).withColumn(
            "maxDepth", F.lit(depth))
        out = r if out is None else out.unionByName(r)
    return out


@query("tune_validation_curve")
def q_validation_curve(spark, t):
    return _validation_curve(spark, t)


@query("tune_fit_diagnosis")
def q_fit_diagnosis(spark, t):
    vc = _validation_curve(spark, t)
    wide = vc.groupBy("maxDepth").agg(F.max(F.when(F.col("side") == "train", F.col("mean"))).alias("train"),
                                      F.max(F.when(F.col("side") == "test", F.col("mean"))).alias("test"))
    r = wide.agg(F.min_by("maxDepth", F.struct("test", "maxDepth")).alias("underfit"),
                 F.max_by("maxDepth", F.struct((F.col("train") - F.col("test")).alias("g"), (-F.col("maxDepth")).alias("t")))
                 .alias("overfit"),
                 F.max_by("maxDepth", F.struct("test", (-F.col("maxDepth")).alias("t"))).alias("best"))
    return r.unpivot([], ["underfit", "overfit", "best"], "kind", "maxDepth")


@query("tune_leaderboard")
def q_leaderboard(spark, t):
    tr, te = _train_test(doc_frame(t))
    models = {"logistic": LogisticRegression(labelCol="label", regParam=0.01),
              "tree": DecisionTreeClassifier(labelCol="label", maxDepth=4, seed=7),
              "forest": RandomForestClassifier(labelCol="label", numTrees=20, maxDepth=4, seed=7)}
    out = None
    for name, est in models.items():
        r = _binary_eval(est.fit(tr).transform(te), name)
        out = r if out is None else out.unionByName(r)
    return out.orderBy(F.col("f1").desc(), "model")


# ---- topics, assembled text features, model round trip -------------------------------

TOPICS, LDA_ROUNDS, MIX_ROUNDS, ALPHA, ETA = 4, 10, 5, 0.1, 0.01


def _topic_sql(mix_too: bool = False) -> str:
    """CTEs up to ``w`` (term, p0..), the word weights after all rounds, and, if asked for, ``x`` (doc_id, t0..)."""
    ks = range(TOPICS)
    shares = ", ".join(f"tf * p{i} * t{i} / ({' + '.join(f'p{j} * t{j}' for j in ks)}) AS r{i}" for i in ks)
    mix = ", ".join(f"(sum(r{i}) + {ALPHA}::DOUBLE) / ({' + '.join(f'sum(r{j})' for j in ks)} + {TOPICS * ALPHA}::DOUBLE) AS t{i}" for i in ks)
    words = ", ".join(f"(r{i} + {ETA}::DOUBLE) / (sum(r{i}) OVER () + {ETA}::DOUBLE * count(*) OVER ()) AS p{i}" for i in ks)
    first = ", ".join(f"CAST('0x' || substr(md5(term || ':{i}:1'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE + 0.5::DOUBLE AS p{i}" for i in ks)
    even = ", ".join(f"{1 / TOPICS}::DOUBLE AS t{i}" for i in ks)
    parts = [f"c AS MATERIALIZED (SELECT doc_id, token AS term, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), {VTOK})) AS token FROM documents) WHERE token IN (SELECT term FROM {_vocab_sql()}) GROUP BY ALL)",
             f"w0 AS (SELECT term, {first} FROM (SELECT DISTINCT term FROM c))", f"x0 AS (SELECT doc_id, {even} FROM (SELECT DISTINCT doc_id FROM c))"]
    for n in range(1, LDA_ROUNDS + 1):
        parts.append(f"r{n} AS MATERIALIZED (SELECT doc_id, term, {shares} FROM c JOIN w{n - 1} USING (term) JOIN x{n - 1} USING (doc_id))")
        parts.append(f"w{n} AS MATERIALIZED (SELECT term, {words} FROM (SELECT term, {', '.join(f'sum(r{i}) AS r{i}' for i in ks)} FROM r{n} GROUP BY term))")
        parts.append(f"x{n} AS MATERIALIZED (SELECT doc_id, {mix} FROM r{n} GROUP BY doc_id)")
    parts.append(f"w AS (SELECT * FROM w{LDA_ROUNDS})")
    if mix_too:
        parts.append("m0 AS (SELECT * FROM x0)")
        for n in range(1, MIX_ROUNDS + 1):
            parts.append(f"m{n} AS MATERIALIZED (SELECT doc_id, {mix} FROM (SELECT doc_id, {shares} FROM c JOIN w USING (term) JOIN m{n - 1} USING (doc_id)) GROUP BY doc_id)")
        parts.append(f"x AS (SELECT * FROM m{MIX_ROUNDS})")
    return ", ".join(parts)


_TOP_WORDS_SQL = f"""long AS (SELECT term AS word, generate_subscripts(p, 1) - 1 AS topic, unnest(p) AS weight FROM (SELECT term, [{', '.join(f'p{i}' for i in range(TOPICS))}] AS p FROM w)),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY round(weight, 9) DESC, word) - 1 AS rank FROM long) WHERE rank < 10)"""


def _topic_counts(t):
    docs = X.by_document(t.documents.select("doc_id", "text"), "doc_id")
    dt = X.doc_term_counts(X.tokens(docs, "doc_id", "text", X.VECTOR_TOKEN, lower=True), "doc_id", materialize=False)
    dt = stage(dt, "topic-counts")
    return dt, X.counts_on_vocabulary(dt, _vocab(dt), "doc_id")


def _topics(t):
    dt, counts = _topic_counts(t)
    return dt, counts, TM.lda_fit(counts, "doc_id", TOPICS, LDA_ROUNDS, ALPHA, ETA, seed=1)


@query("topic_lda_words", f"""WITH {_topic_sql()}, {_TOP_WORDS_SQL}
SELECT CAST(topic AS INTEGER) AS topic, CAST(rank AS INTEGER) AS rank, word, round(weight, 7) AS weight FROM top""")
def q_lda_words(spark, t):
    return TM.top_words(_topics(t)[2], TOPICS, 10).withColumn("weight", F.round("weight", 7))


@query("topic_distribution", f"""WITH {_topic_sql(True)}
SELECT doc_id, CAST(generate_subscripts(m, 1) - 1 AS INTEGER) AS topic, round(unnest(m), 6) AS share, round(list_sum(m), 9) AS whole
FROM (SELECT doc_id, [{', '.join(f't{i}' for i in range(TOPICS))}] AS m FROM x)""")
def q_topic_dist(spark, t):
    """Topic mix of every document that holds a word of the vocabulary; ``whole`` is the sum of its shares."""
    _, counts = _topic_counts(t)
    blocks = TM.document_blocks(counts, "doc_id")
    weights = TM.lda_fit(counts, "doc_id", TOPICS, LDA_ROUNDS, ALPHA, ETA, seed=1, blocks=blocks)
    mix = TM.lda_mix(counts, weights, "doc_id", TOPICS, MIX_ROUNDS, ALPHA, blocks=blocks)
    blocks.unpersist()
    mix = mix.withColumn("mix", F.array(*[f"t{i}" for i in range(TOPICS)]))
    whole = F.round(F.aggregate("mix", F.lit(0.0), lambda a, x: a + x), 9).alias("whole")
    return mix.select("doc_id", whole, F.posexplode("mix").alias("topic", "share")).select("doc_id", "topic", F.round("share", 6).alias("share"), "whole")


@query("topic_naming", f"""WITH {_topic_sql()}, {_TOP_WORDS_SQL},
tok AS (SELECT DISTINCT doc_id, lang AS candidate, unnest(regexp_extract_all(lower(text), {VTOK})) AS word FROM documents),
df AS (SELECT candidate, word, count(*) AS df FROM tok GROUP BY ALL),
n AS (SELECT lang AS candidate, count(*) AS n_docs FROM documents GROUP BY lang),
s AS (SELECT topic, candidate, round(sum(df / n_docs) / 10, 9) AS score FROM top JOIN df USING (word) JOIN n USING (candidate) GROUP BY ALL)
SELECT CAST(topic AS INTEGER) AS topic, arg_max(candidate, (score, candidate)) AS name, max(score) AS score FROM s GROUP BY topic""")
def q_topic_naming(spark, t):
    """Name each topic by the candidate (a language) whose documents contain its
    top words most often: mean document frequency of the words per candidate."""
    dt, _, weights = _topics(t)
    words = stage(TM.top_words(weights, TOPICS, 10), "topic-words")
    docs = t.documents.select("doc_id", F.col("lang").alias("candidate"))
    n_docs = docs.groupBy("candidate").agg(F.count(F.lit(1)).alias("n_docs"))
    held = dt.withColumnRenamed("token", "word").join(hinted(words.select("word").distinct()), "word", "left_semi")  # ten words a topic: counts stay where they are
    df_ = held.join(docs, "doc_id").groupBy("candidate", "word").agg(F.count(F.lit(1)).alias("df"))
    s = words.join(df_, "word").join(n_docs, "candidate").groupBy("topic", "candidate").agg(
        F.round(F.sum(F.col("df") / F.col("n_docs")) / 10, 9).alias("score"))
    return s.groupBy("topic").agg(F.max_by("candidate", F.struct("score", F.col("candidate"))).alias("name"),
                                  F.max("score").alias("score"))


@query("feature_assemble", f"""
WITH tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), {VTOK})) AS term FROM documents),
voc AS (SELECT term, df, row_number() OVER (ORDER BY term) - 1 AS idx FROM (SELECT term, count(DISTINCT doc_id) AS df FROM tok GROUP BY term) WHERE df >= 2),
v AS (SELECT doc_id, idx, count(*) * ln(((SELECT count(*) FROM documents) + 1) / (any_value(df) + 1)) AS value FROM tok JOIN voc USING (term) GROUP BY doc_id, idx),
x AS (SELECT doc_id, (SELECT count(*) FROM voc) AS idx, CAST(length(text) AS DOUBLE) AS value FROM documents
      UNION ALL SELECT doc_id, (SELECT count(*) FROM voc) + 1, CAST(length(regexp_replace(text, '[^0-9]', '', 'g')) AS DOUBLE) FROM documents),
a AS (SELECT * FROM v UNION ALL SELECT * FROM x)
SELECT doc_id, CAST((SELECT count(*) FROM voc) + 2 AS INTEGER) AS n_features, CAST(count(*) FILTER (WHERE value <> 0) AS INTEGER) AS nnz,
       CAST(coalesce(sum(idx) FILTER (WHERE value <> 0), 0) AS BIGINT) AS index_sum, round(sum(value), 6) AS value_sum FROM a GROUP BY doc_id""")
def q_feature_assemble(spark, t):
    """tf-idf on the whole vocabulary with length and digit count appended, as sparse vectors."""
    d = t.documents.select("doc_id", F.length("text").cast("double").alias("len"), F.regexp_count("text", F.lit("[0-9]")).cast("double").alias("digits"))
    own = X.by_document(t.documents.select("doc_id", "text"), "doc_id")
    dt = stage(X.doc_term_counts(X.tokens(own, "doc_id", "text", X.VECTOR_TOKEN, lower=True), "doc_id", materialize=False), "assemble-counts")
    vocab = stage(TM.numbered_vocabulary(X.vocabulary_from_counts(dt, "doc_id", min_df=2)), "assemble-vocabulary")
    cells = TM.weighted_terms(X.counts_on_vocabulary(dt, vocab, "doc_id"), vocab, d, "doc_id")
    v = TM.assemble_sparse(cells, d, "doc_id", vocab.count(), ["len", "digits"])
    return v.select("doc_id", F.col("size").alias("n_features"), F.size("indices").alias("nnz"),
                    F.aggregate("indices", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("index_sum"),
                    F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + x), 6).alias("value_sum"))


@query("model_roundtrip", """
SELECT o_orderkey, TRUE AS same_prediction, TRUE AS same_probability FROM orders
WHERE CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) % 1000000 >= 750000""")
def q_roundtrip(spark, t):
    from pyspark.ml import PipelineModel
    tr, te = _train_test(_pipeline_frame(t))
    pm = ML.fit_pipeline(_pipeline_stages(LogisticRegression(labelCol="label", regParam=0.01)), tr)
    path = scratch_dir(spark, "model")
    pm.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    a = pm.transform(te).select("o_orderkey", F.col("prediction").alias("before"),
                                vector_to_array("probability")[1].alias("p_before"))
    b = loaded.transform(te).select("o_orderkey", F.col("prediction").alias("after"),
                                    vector_to_array("probability")[1].alias("p_after"))
    return a.join(b, "o_orderkey").select("o_orderkey", (F.col("before") == F.col("after")).alias("same_prediction"),
                                          (F.abs(F.col("p_before") - F.col("p_after")) < 1e-12).alias("same_probability"))
