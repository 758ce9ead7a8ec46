"""Supervised models on Spark ML (M rows).

Features are assembled into vectors with ``VectorAssembler``; estimators are
Spark ML's distributed implementations (gradient by ``treeAggregate``, trees by
per-partition histograms), so the data never leaves the executors: only
model parameters reach the driver.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.subquery import scalar_row


def majority_class(train: DataFrame, label: str) -> DataFrame:
    """One row: the most frequent label (ties to the smallest label)."""
    c = train.groupBy(label).agg(F.count(F.lit(1)).alias("__cnt"))
    return c.agg(F.min_by(label, F.struct((-F.col("__cnt")).alias("a"), F.col(label).alias("b"))).alias("majority"))


def majority_baseline(train: DataFrame, test: DataFrame, label: str, out: str = "prediction") -> DataFrame:
    """Predict the training mode for every test row."""
    return test.withColumn(out, scalar_row(majority_class(train, label))["majority"])


# ---- shared helpers ------------------------------------------------------------


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def positive_probability(df: DataFrame, prob_col: str = "probability", out: str = "p1") -> DataFrame:
    """P(class 1) as a column (the score to rank by; never ``rawPrediction`` of NaiveBayes)."""
    return df.withColumn(out, vector_to_array(F.col(prob_col))[1])


def coefficient_table(spark, names: list[str], values, intercept: float | None = None) -> DataFrame:
    """Model parameters (bounded by the feature count) as rows ``(feature, coefficient)``."""
    rows = [(n, float(v)) for n, v in zip(names, list(values))]
    if intercept is not None:
        rows.append(("(intercept)", float(intercept)))
    return spark.createDataFrame(rows, "feature string, coefficient double")


def feature_names(df: DataFrame, features_col: str = "features") -> list[str]:
    """Slot names from the ML attribute metadata of an assembled vector column."""
    meta = df.schema[features_col].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    slots = sorted((a["idx"], a["name"]) for group in attrs.values() for a in group)
    return [n for _, n in slots] or [f"f{i}" for i in range(meta.get("num_attrs", 0))]


def tree_rules(spark, model) -> DataFrame:
    """``toDebugString`` of a tree model, one row per line."""
    lines = model.toDebugString.splitlines()
    return spark.createDataFrame([(i, ln) for i, ln in enumerate(lines)], "line_no int, rule string")


def importance_table(spark, names: list[str], importances, k: int | None = None) -> DataFrame:
    """Non-zero importances by name, largest first (ties by name), optionally top k."""
    rows = [(n, float(v)) for n, v in zip(names, importances.toArray()) if v > 0]
    rows.sort(key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(rows[:k] if k else rows, "feature string, importance double")


def random_fourier_features(df: DataFrame, cols: list[str], n_components: int, gamma: float,
                            seed: int = 0, prefix: str = "rff") -> DataFrame:
    """RBF-kernel approximation: z_j(x) = sqrt(2/D) cos(w_j . x + b_j), w ~ N(0, 2 gamma),
    b ~ U(0, 2 pi). Weights are a parameter-sized draw; the mapping is column
    arithmetic (codegen), so a linear model on z approximates an RBF SVM."""
    rng = np.random.RandomState(seed)
    w = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_components, len(cols)))
    b = rng.uniform(0.0, 2.0 * math.pi, size=n_components)
    scale = math.sqrt(2.0 / n_components)
    exprs = {}
    for j in range(n_components):
        dot = sum(F.col(c).cast("double") * float(w[j, i]) for i, c in enumerate(cols)) + float(b[j])
        exprs[f"{prefix}_{j}"] = F.lit(scale) * F.cos(dot)
    return df.withColumns(exprs)


def original_units(coefficients: list[float], intercept: float, means: list[float], deviations: list[float]) -> tuple[list[float], float]:
    """Coefficients of ``(x - mean) / deviation`` as those of ``x``; a constant column has none."""
    own = [c / s if s else 0.0 for c, s in zip(coefficients, deviations)]
    return own, intercept - sum(c * m for c, m in zip(own, means))


def logistic_optimality(df: DataFrame, features: list[str], label: str, weights: list[float], intercept: float, ridge: float = 0.0, lasso: float = 0.0) -> DataFrame:
    """One row: how far a logistic fit is from its optimum, ``residual``.

    The largest violation of the conditions that the minimum of mean log loss +
    ridge / 2 * |w|^2 + lasso * |w|_1 (intercept free) must meet: the gradient is
    zero, or for a weight at zero within the lasso. Computed from the rows, with
    no regard to how the fit was made.
    """
    z = F.lit(float(intercept))
    for c, w in zip(features, weights):
        z = z + F.col(c) * F.lit(float(w))
    off = F.lit(1.0) / (F.lit(1.0) + F.exp(-z)) - F.col(label)
    grads = df.agg(F.avg(off).alias("g_"), *[F.avg(off * F.col(c)).alias(f"g_{c}") for c in features])
    parts = [F.abs("g_")]
    for c, w in zip(features, weights):
        g = F.col(f"g_{c}") + F.lit(ridge * float(w))
        parts.append(F.abs(g + F.lit(math.copysign(lasso, w))) if w else F.greatest(F.abs(g) - F.lit(lasso), F.lit(0.0)))
    return grads.select(F.greatest(*parts).alias("residual"))


def fit_pipeline(stages: list, train: DataFrame) -> PipelineModel:
    return Pipeline(stages=stages).fit(train)
