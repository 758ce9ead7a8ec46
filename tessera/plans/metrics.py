"""E rows: metrics on deterministic prediction frames built from the test tables.

Binary frame: label = labels.quality; score = vowel share of the text in
thousandths (integer arithmetic, so every engine computes the same double);
prediction = score >= 0.25. Multiclass frame: label = documents.lang;
prediction = a rule on accented letters; one score per class for one-vs-rest.
"""

from pyspark.sql import functions as F

from tessera.functions.hashing import portable_hash
from tessera.functions.subquery import attach_row
from tessera.operators import metrics as M
from tessera.operators.profile import histogram
from tessera.plans.registry import query

CLASSES = ["de", "en", "es", "fr"]
# Letters marking each language for the rule-based predictor.
LANG_MARKS = {"fr": "[éèêàçù]", "de": "[äöüß]", "es": "[ñáíóú¿¡]", "en": "[wkyh]"}


def binary_frame(t):
    d = t.documents.join(t.labels, "doc_id")
    k = F.expr("(regexp_count(text, '[aeiou]') * 1000) div length(text)")
    return d.select("doc_id", F.col("quality").alias("label"), (k / F.lit(1000.0)).alias("score")).withColumn(
        "pred", (F.col("score") >= 0.25).cast("int"))


def multi_frame(t):
    d = t.documents
    rule = (F.when(F.col("text").rlike("[éèêàçù]"), "fr").when(F.col("text").rlike("[äöüß]"), "de")
            .when(F.col("text").rlike("[ñ¿¡]"), "es").otherwise("en"))
    scores = {f"score_{c}": F.expr(f"(regexp_count(text, '{p}') * 1000) div length(text)") / F.lit(1000.0)
              for c, p in LANG_MARKS.items()}
    return d.select("doc_id", F.col("lang").alias("label"), rule.alias("pred"), *[v.alias(k) for k, v in scores.items()])


BIN_SQL = """(SELECT doc_id, quality AS label, score, CAST(score >= 0.25 AS INTEGER) AS pred FROM
  (SELECT doc_id, quality, ((length(regexp_replace(text, '[^aeiou]', '', 'g')) * 1000) // length(text)) / 1000.0 AS score
   FROM documents JOIN labels USING (doc_id)))"""


def _score_sql(c):
    return f"((length(regexp_replace(text, '[^{LANG_MARKS[c][1:-1]}]', '', 'g')) * 1000) // length(text)) / 1000.0 AS score_{c}"


MULTI_SQL = f"""(SELECT doc_id, lang AS label,
  CASE WHEN regexp_matches(text, '[éèêàçù]') THEN 'fr' WHEN regexp_matches(text, '[äöüß]') THEN 'de'
       WHEN regexp_matches(text, '[ñ¿¡]') THEN 'es' ELSE 'en' END AS pred,
  {', '.join(_score_sql(c) for c in CLASSES)} FROM documents)"""


def r9(c):
    return F.round(c, 9).alias(c)


@query("metric_binary", f"""
SELECT 'vowel_rule' AS model, count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE label <> 1 AND pred = 1) AS fp,
  count(*) FILTER (WHERE label = 1 AND pred <> 1) AS fn, count(*) FILTER (WHERE label <> 1 AND pred <> 1) AS tn,
  round(avg(CAST(label = pred AS DOUBLE)), 9) AS accuracy,
  round(count(*) FILTER (WHERE label = 1 AND pred = 1) / count(*) FILTER (WHERE pred = 1), 9) AS precision,
  round(count(*) FILTER (WHERE label = 1 AND pred = 1) / count(*) FILTER (WHERE label = 1), 9) AS recall,
  round(2.0 * count(*) FILTER (WHERE label = 1 AND pred = 1) / (count(*) FILTER (WHERE pred = 1) + count(*) FILTER (WHERE label = 1)), 9) AS f1
FROM {BIN_SQL}""")
def q_binary(spark, t):
    m = M.binary_metrics(binary_frame(t), "label", "pred", 1, "vowel_rule")
    return m.select("model", "tp", "fp", "fn", "tn", r9("accuracy"), r9("precision"), r9("recall"), r9("f1"))


_PC_SQL = f"""pc AS (SELECT c AS class, count(*) FILTER (WHERE label = c AND pred = c) AS tp, count(*) FILTER (WHERE pred = c) AS n_pred,
  count(*) FILTER (WHERE label = c) AS support FROM {MULTI_SQL}, (VALUES ('de'), ('en'), ('es'), ('fr')) v(c) GROUP BY c),
pcm AS (SELECT class, coalesce(tp / nullif(n_pred, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall, support FROM pc),
pcf AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM pcm)"""


@query("metric_macro", f"""
WITH {_PC_SQL}
SELECT round(avg(precision), 9) AS macro_precision, round(avg(recall), 9) AS macro_recall, round(avg(f1), 9) AS macro_f1,
  round((SELECT avg(CAST(label = pred AS DOUBLE)) FROM {MULTI_SQL}), 9) AS accuracy FROM pcf""")
def q_macro(spark, t):
    m = M.macro(multi_frame(t), "label", "pred")
    return m.select(*[r9(c) for c in m.columns])


@query("metric_report", f"""
WITH {_PC_SQL}
SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM pcf
UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), sum(support)::BIGINT FROM pcf
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9),
  round(sum(f1 * support) / sum(support), 9), sum(support)::BIGINT FROM pcf
UNION ALL SELECT 'accuracy', NULL, NULL, round(avg(CAST(label = pred AS DOUBLE)), 9), count(*) FROM {MULTI_SQL}""")
def q_report(spark, t):
    r = M.report(multi_frame(t), "label", "pred")
    return r.select("class", r9("precision"), r9("recall"), r9("f1"), "support")


@query("metric_confusion", f"""
SELECT a.c AS label, b.c AS pred, count(m.doc_id) AS n
FROM (VALUES ('de'), ('en'), ('es'), ('fr')) a(c) CROSS JOIN (VALUES ('de'), ('en'), ('es'), ('fr')) b(c)
LEFT JOIN {MULTI_SQL} m ON m.label = a.c AND m.pred = b.c GROUP BY a.c, b.c""")
def q_confusion(spark, t):
    return M.confusion(multi_frame(t), "label", "pred")


@query("metric_class_accuracy", f"""
SELECT CASE WHEN CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) % 1000000 < 800000
  THEN 'train' ELSE 'test' END AS split, label, round(avg(CAST(label = pred AS DOUBLE)), 9) AS accuracy, count(*) AS n
FROM {MULTI_SQL} GROUP BY 1, 2""")
def q_class_accuracy(spark, t):
    f = multi_frame(t)
    u = portable_hash("doc_id", seed=42) % 1000000
    f = f.withColumn("split", F.when(u < 800000, "train").otherwise("test"))
    return f.groupBy("split", "label").agg(F.round(F.avg((F.col("label") == F.col("pred")).cast("double")), 9)
                                           .alias("accuracy"), F.count(F.lit(1)).alias("n"))


def _ovr(t):
    return M.one_vs_rest(multi_frame(t), "label", {c: f"score_{c}" for c in CLASSES})


@query("metric_roc_curve", " UNION ALL ".join(f"""
SELECT '{c}' AS class, threshold, round(fp / n_neg, 9) AS fpr, round(tp / n_pos, 9) AS tpr FROM (
  SELECT threshold, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(neg) OVER (ORDER BY threshold DESC) AS fp,
    sum(pos) OVER () AS n_pos, sum(neg) OVER () AS n_neg FROM
    (SELECT score_{c} AS threshold, count(*) FILTER (WHERE label = '{c}') AS pos, count(*) FILTER (WHERE label <> '{c}') AS neg
     FROM {MULTI_SQL} GROUP BY 1))""" for c in CLASSES))
def q_roc(spark, t):
    return M.roc_curve(_ovr(t), "y", "score", by=["class"]).select("class", "threshold", r9("fpr"), r9("tpr"))


@query("metric_roc_auc", f"""
SELECT round(avg(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0.0 END), 12) AS auc
FROM {BIN_SQL} p JOIN {BIN_SQL} n ON p.label = 1 AND n.label <> 1""")
def q_auc(spark, t):
    return M.roc_auc(binary_frame(t), "label", "score").select(F.round("auc", 12).alias("auc"))


@query("metric_auc_ovr", "WITH m AS " + MULTI_SQL + ", per AS (" + " UNION ALL ".join(f"""
SELECT '{c}' AS class, avg(CASE WHEN p.score_{c} > n.score_{c} THEN 1.0 WHEN p.score_{c} = n.score_{c} THEN 0.5 ELSE 0.0 END) AS auc
FROM m p JOIN m n ON p.label = '{c}' AND n.label <> '{c}'""" for c in CLASSES) + """)
SELECT class, round(auc, 12) AS auc FROM per UNION ALL SELECT 'macro', round(avg(auc), 12) FROM per""")
def q_auc_ovr(spark, t):
    per = M.roc_auc(_ovr(t), "y", "score", by=["class"]).select("class", "auc")
    macro = per.agg(F.lit("macro").alias("class"), F.avg("auc").alias("auc"))
    return per.unionByName(macro).withColumn("auc", F.round("auc", 12))


_CURVE_SQL = f"""(SELECT threshold, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(neg) OVER (ORDER BY threshold DESC) AS fp,
    sum(pos) OVER () AS n_pos, sum(neg) OVER () AS n_neg FROM
    (SELECT score AS threshold, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
     FROM {BIN_SQL} GROUP BY 1))"""


@query("metric_pr_curve", f"""
SELECT 'quality' AS class, threshold, round(tp / (tp + fp), 9) AS precision, round(tp / n_pos, 9) AS recall FROM {_CURVE_SQL}
""" + "".join(f"""UNION ALL SELECT '{c}', threshold, round(tp / (tp + fp), 9), round(tp / n_pos, 9) FROM (
  SELECT threshold, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(neg) OVER (ORDER BY threshold DESC) AS fp, sum(pos) OVER () AS n_pos FROM
    (SELECT score_{c} AS threshold, count(*) FILTER (WHERE label = '{c}') AS pos, count(*) FILTER (WHERE label <> '{c}') AS neg
     FROM {MULTI_SQL} GROUP BY 1)) """ for c in CLASSES))
def q_pr(spark, t):
    """Curves of the binary score and of every language against the rest."""
    rows = binary_frame(t).select(F.lit("quality").alias("class"), F.col("label").alias("y"), "score").unionByName(_ovr(t))
    return M.pr_curve(rows, "y", "score", by=["class"]).select("class", "threshold", r9("precision"), r9("recall"))


@query("metric_curve_lookup", f"""
SELECT round(max(CASE WHEN tp / (tp + fp) >= 0.9 THEN tp / n_pos END), 9) AS recall_at_precision,
       round(max(CASE WHEN fp / n_neg <= 0.1 THEN tp / n_pos END), 9) AS tpr_at_fpr FROM {_CURVE_SQL}""")
def q_lookup(spark, t):
    f = binary_frame(t)
    pr = M.pr_curve(f, "label", "score")
    roc = M.roc_curve(f, "label", "score")
    a = pr.agg(F.round(F.max(F.when(F.col("precision") >= 0.9, F.col("recall"))), 9).alias("recall_at_precision"))
    b = roc.agg(F.round(F.max(F.when(F.col("fpr") <= 0.1, F.col("tpr"))), 9).alias("tpr_at_fpr"))
    return attach_row(a, b)


@query("metric_threshold_rule", f"""
SELECT count(*) FILTER (WHERE label = 1 AND score >= 0.3) AS tp, count(*) FILTER (WHERE label <> 1 AND score >= 0.3) AS fp,
  count(*) FILTER (WHERE label = 1 AND score < 0.3) AS fn, count(*) FILTER (WHERE label <> 1 AND score < 0.3) AS tn,
  round(count(*) FILTER (WHERE label = 1 AND score >= 0.3) / count(*) FILTER (WHERE score >= 0.3), 9) AS precision,
  round(count(*) FILTER (WHERE label = 1 AND score >= 0.3) / count(*) FILTER (WHERE label = 1), 9) AS recall
FROM {BIN_SQL}""")
def q_threshold_rule(spark, t):
    f = binary_frame(t).withColumn("pred", (F.col("score") >= 0.3).cast("int"))
    m = M.binary_metrics(f, "label", "pred")
    return m.select("tp", "fp", "fn", "tn", r9("precision"), r9("recall"))


@query("metric_threshold_finder", f"""
WITH g AS (SELECT range AS i, range / 1000.0 AS threshold FROM range(1001)),
r AS (SELECT i, threshold, (SELECT count(*) FROM {BIN_SQL} WHERE label = 1 AND score >= threshold)
        / (SELECT count(*) FROM {BIN_SQL} WHERE label = 1) AS recall FROM g)
SELECT arg_min(threshold, (abs(recall - 0.5), i)) AS threshold, round(arg_min(recall, (abs(recall - 0.5), i)), 9) AS recall FROM r""")
def q_threshold_finder(spark, t):
    r = M.threshold_finder(binary_frame(t), "label", "score", 0.5)
    return r.select("threshold", r9("recall"))


_REG_SQL = """(SELECT l_orderkey, l_linenumber, y, regr_slope(y, x) OVER () * x + regr_intercept(y, x) OVER () AS p FROM
  (SELECT l_orderkey, l_linenumber, l_extendedprice / 100000.0 AS y, l_quantity AS x FROM lineitem))"""


def reg_frame(t):
    li = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") / 100000.0).alias("y"),
                           F.col("l_quantity").alias("x"))
    line = li.agg(F.regr_slope("y", "x").alias("__b"), F.regr_intercept("y", "x").alias("__a"))
    li = attach_row(li, line)
    return li.select("l_orderkey", "l_linenumber", "y", (F.col("__b") * F.col("x") + F.col("__a")).alias("p"))


@query("metric_regression", f"""
SELECT round(1 - sum((y - p) * (y - p)) / sum((y - ybar) * (y - ybar)), 9) AS r2, round(avg(abs(y - p)), 9) AS mae,
  round(avg((y - p) * (y - p)), 9) AS mse, round(sqrt(avg((y - p) * (y - p))), 9) AS rmse
FROM (SELECT *, avg(y) OVER () AS ybar FROM {_REG_SQL})""")
def q_regression(spark, t):
    m = M.regression_metrics(reg_frame(t), "y", "p")
    return m.select(*[r9(c) for c in m.columns])


@query("metric_residuals", f"""
SELECT l_orderkey, l_linenumber, round(y, 9) AS actual, round(p, 9) AS predicted, round(y - p, 9) AS residual FROM {_REG_SQL}""")
def q_residuals(spark, t):
    r = reg_frame(t)
    return r.select("l_orderkey", "l_linenumber", F.round("y", 9).alias("actual"), F.round("p", 9).alias("predicted"),
                    F.round(F.col("y") - F.col("p"), 9).alias("residual"))


@query("metric_residual_histogram", f"""
WITH r AS (SELECT round(y - p, 9) AS x FROM {_REG_SQL}), s AS (SELECT min(x) AS lo, max(x) AS hi, avg(x) AS m, (max(x) - min(x)) / 20 AS w FROM r),
h AS (SELECT CAST(least(floor((x - lo) / w), 19) AS INTEGER) AS bin, count(*) AS n FROM r, s GROUP BY 1)
SELECT bin, n, round(lo + bin * w, 9) AS bin_lo, round(lo + (bin + 1) * w, 9) AS bin_hi, round(m, 9) AS mean_residual FROM h, s""")
def q_residual_histogram(spark, t):
    """Histogram of the residuals, and their mean."""
    r = reg_frame(t).select(F.round(F.col("y") - F.col("p"), 9).alias("x"))
    h = attach_row(histogram(r, "x", 20), r.agg(F.avg("x").alias("mean_residual")))
    return h.select("bin", "n", r9("bin_lo"), r9("bin_hi"), r9("mean_residual"))


@query("metric_lift_baseline", f"""
WITH f AS (SELECT *, CASE WHEN CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) % 1000000 < 800000
             THEN 'train' ELSE 'test' END AS split FROM {BIN_SQL}),
maj AS (SELECT arg_min(label, (-cnt, label)) AS m FROM (SELECT label, count(*) AS cnt FROM f WHERE split = 'train' GROUP BY 1)),
te AS (SELECT f.*, maj.m AS base FROM f, maj WHERE split = 'test')
SELECT 'vowel_rule' AS model, round(avg(CAST(label = pred AS DOUBLE)), 9) AS accuracy,
  round(count(*) FILTER (WHERE label = 1 AND pred = 1) / count(*) FILTER (WHERE label = 1), 9) AS recall FROM te
UNION ALL SELECT 'majority', round(avg(CAST(label = base AS DOUBLE)), 9),
  round(count(*) FILTER (WHERE label = 1 AND base = 1) / count(*) FILTER (WHERE label = 1), 9) FROM te""")
def q_lift(spark, t):
    from tessera.operators.models import majority_baseline
    f = binary_frame(t)
    u = portable_hash("doc_id", seed=42) % 1000000
    f = f.withColumn("split", F.when(u < 800000, "train").otherwise("test"))
    te = majority_baseline(f.where(F.col("split") == "train"), f.where(F.col("split") == "test"), "label", "base")
    out = None
    for name, col in (("vowel_rule", "pred"), ("majority", "base")):
        m = M.binary_metrics(te, "label", col).select(F.lit(name).alias("model"), r9("accuracy"), r9("recall"))
        out = m if out is None else out.unionByName(m)
    return out
