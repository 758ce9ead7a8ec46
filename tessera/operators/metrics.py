"""Evaluation metrics on ``(label, prediction, score)`` frames (E rows).

Counts are conditional sums in one aggregate; curves group by distinct score
and take running sums with the distributed prefix-sum helper, so no step puts
all rows (or all scores) in a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql import Window

from tessera.functions.ordering import keyed_prefix_sums
from tessera.functions.staging import stage
from tessera.functions.subquery import attach_row
from tessera.operators.categories import cell_counts, full_grid


def _div(a, b):
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def binary_counts(df: DataFrame, label: str, pred: str, positive=1) -> DataFrame:
    y, p = F.col(label) == F.lit(positive), F.col(pred) == F.lit(positive)
    return df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                  F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))


def binary_metrics(df: DataFrame, label: str, pred: str, positive=1, name: str | None = None) -> DataFrame:
    c = binary_counts(df, label, pred, positive)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    prec, rec = _div(tp, tp + fp), _div(tp, tp + fn)
    out = c.select("tp", "fp", "fn", "tn", _div(tp + tn, tp + fp + fn + tn).alias("accuracy"),
                   prec.alias("precision"), rec.alias("recall"), _div(2 * prec * rec, prec + rec).alias("f1"))
    return out.withColumn("model", F.lit(name)) if name else out


def per_class(df: DataFrame, label: str, pred: str) -> DataFrame:
    """precision, recall, f1, support for each class of either column (zero division -> 0).

    Every row is counted once under its label and once under its prediction, so
    one grouped sum serves any number of classes. A null label or prediction is
    no class.
    """
    y, p = F.col(label).cast("string"), F.col(pred).cast("string")
    both = F.array(F.struct(y.alias("class"), F.lit(1).alias("s"), F.lit(0).alias("p"), F.coalesce((y == p).cast("int"), F.lit(0)).alias("t")),
                   F.struct(p.alias("class"), F.lit(0).alias("s"), F.lit(1).alias("p"), F.lit(0).alias("t")))
    row = df.select(F.inline(both)).where("class IS NOT NULL").groupBy("class").agg(
        F.sum("t").alias("tp"), F.sum("p").alias("n_pred"), F.sum("s").alias("support"))
    prec, rec = _div(F.col("tp"), F.col("n_pred")), _div(F.col("tp"), F.col("support"))
    return row.select("class", prec.alias("precision"), rec.alias("recall"),
                      _div(2 * prec * rec, prec + rec).alias("f1"), "support")


def macro(df: DataFrame, label: str, pred: str) -> DataFrame:
    pc = per_class(df, label, pred)
    acc = df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))
    m = pc.agg(F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
               F.avg("f1").alias("macro_f1"))
    return attach_row(m, acc)


def report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per-class rows + accuracy, macro avg and weighted avg rows."""
    pc = per_class(df, label, pred)
    n = F.sum("support")
    mac = pc.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                 F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), n.alias("support"))
    wei = pc.agg(F.lit("weighted avg").alias("class"),
                 (F.sum(F.col("precision") * F.col("support")) / n).alias("precision"),
                 (F.sum(F.col("recall") * F.col("support")) / n).alias("recall"),
                 (F.sum(F.col("f1") * F.col("support")) / n).alias("f1"), n.alias("support"))
    acc = df.agg(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"),
                 F.avg((F.col(label) == F.col(pred)).cast("double")).alias("f1"),
                 F.count(F.lit(1)).alias("support"))
    return pc.unionByName(mac).unionByName(wei).unionByName(acc)


def confusion(df: DataFrame, label: str, pred: str, classes: list | None = None, zeros: bool = True) -> DataFrame:
    """Long form ``(label, prediction, n)``: every pair of classes that occur (or are given as ``classes``), zero
    cells kept, or (``zeros`` False) only the pairs that occur."""
    return full_grid(df, label, pred, classes) if zeros else cell_counts(df, label, pred)


def score_table(df: DataFrame, label: str, score: str, positive=1, by: list[str] | tuple = ()) -> DataFrame:
    """``(by, threshold, pos, neg)``: a row per group and distinct score."""
    y = F.coalesce((F.col(label) == F.lit(positive)).cast("long"), F.lit(0))
    st = df.groupBy(*by, F.col(score).cast("double").alias("threshold")).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    return stage(st, "scores")  # read by several passes of the running sums


def one_vs_rest(df: DataFrame, label: str, scores: dict[str, str]) -> DataFrame:
    """``(class, y, score)``: a row per row and class, made in the one pass that reads ``df``; ``scores`` maps class to score column."""
    rows = [F.struct(F.lit(c).alias("class"), (F.col(label) == F.lit(c)).cast("int").alias("y"), F.col(s).cast("double").alias("score")) for c, s in scores.items()]
    return df.select(F.inline(F.array(*rows)))


def curve_points(df: DataFrame, label: str, score: str, positive=1, by: list[str] | tuple = ()) -> DataFrame:
    """tp/fp at every distinct threshold (score >= threshold), plus P and N, for each group of ``by``."""
    by = list(by)
    st = score_table(df, label, score, positive, by).withColumn("__neg_t", -F.col("threshold"))
    run = keyed_prefix_sums(st, by, ["__neg_t"], {"tp": "pos", "fp": "neg"}).drop("__neg_t")
    tot = st.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return run.join(tot, by) if by else attach_row(run, tot)


def roc_curve(df: DataFrame, label: str, score: str, positive=1, by: list[str] | tuple = ()) -> DataFrame:
    c = curve_points(df, label, score, positive, by)
    return c.select(*by, "threshold", _div(F.col("fp"), F.col("N")).alias("fpr"), _div(F.col("tp"), F.col("P")).alias("tpr"))


def pr_curve(df: DataFrame, label: str, score: str, positive=1, by: list[str] | tuple = ()) -> DataFrame:
    c = curve_points(df, label, score, positive, by)
    return c.select(*by, "threshold", _div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                    _div(F.col("tp"), F.col("P")).alias("recall"))


def roc_auc(df: DataFrame, label: str, score: str, positive=1, by: list[str] | tuple = ()) -> DataFrame:
    """AUC = P(score_pos > score_neg) + 0.5 P(equal), for each group of ``by``: per distinct
    score, positives times negatives strictly below (running sum) plus half the ties."""
    by = list(by)
    run = keyed_prefix_sums(score_table(df, label, score, positive, by), by, ["threshold"], {"neg_to": "neg"})
    return run.groupBy(*by).agg((F.sum(F.col("pos") * (F.col("neg_to") - 0.5 * F.col("neg")))
                                 / (F.sum("pos").cast("double") * F.sum("neg"))).alias("auc"))


def threshold_finder(df: DataFrame, label: str, score: str, target_recall: float, steps: int = 1000,
                     positive=1) -> DataFrame:
    """Grid threshold i/steps whose recall (score >= t) is nearest the target;
    lowest threshold on ties. One pass: positives are histogrammed into grid
    cells, then a suffix sum over the (parameter-sized) grid."""
    s = F.col(score).cast("double")
    b = F.floor(s * steps).cast("long")
    # exact cell: the largest i with i/steps <= score
    b = F.when((b + 1) / F.lit(float(steps)) <= s, b + 1).when(b / F.lit(float(steps)) > s, b - 1).otherwise(b)
    pos = df.where(F.col(label) == F.lit(positive)).select(F.least(F.greatest(b, F.lit(-1)), F.lit(steps)).alias("i"))
    hist = pos.groupBy("i").agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(steps + 1).withColumnRenamed("id", "i")
    g = grid.join(hist, "i", "left").fillna(0, ["n"])
    total = pos.agg(F.count(F.lit(1)).alias("P"))
    w = Window.orderBy(F.col("i").desc()).rowsBetween(Window.unboundedPreceding, 0)  # grid rows only
    g = g.withColumn("tp", F.sum("n").over(w))
    g = attach_row(g, total).withColumn("recall", _div(F.col("tp"), F.col("P")))
    best = g.agg(F.min_by("i", F.struct(F.abs(F.col("recall") - target_recall).alias("d"), F.col("i"))).alias("i"))
    return best.join(g, "i").select((F.col("i") / F.lit(float(steps))).alias("threshold"), "recall")


def regression_metrics(df: DataFrame, actual: str, pred: str) -> DataFrame:
    y, p = F.col(actual).cast("double"), F.col(pred).cast("double")
    m = df.agg(F.avg(y).alias("__ybar"))
    x = attach_row(df.select(y.alias("y"), p.alias("p")), m)
    r = x.agg(F.sum(F.pow(F.col("y") - F.col("p"), 2)).alias("sse"),
              F.sum(F.pow(F.col("y") - F.col("__ybar"), 2)).alias("sst"),
              F.avg(F.abs(F.col("y") - F.col("p"))).alias("mae"), F.count(F.lit(1)).alias("n"))
    return r.select((1 - F.col("sse") / F.col("sst")).alias("r2"), "mae", (F.col("sse") / F.col("n")).alias("mse"),
                    F.sqrt(F.col("sse") / F.col("n")).alias("rmse"))
