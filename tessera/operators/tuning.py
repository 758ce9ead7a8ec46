"""Model selection (G rows): folds from the seeded hash, one fit per
(parameters, fold) on Spark ML, metrics computed as DataFrame aggregates.

Fits are distributed jobs; the loop over the (small, user-given) grid runs on
the driver, as ``CrossValidator`` itself does. Folds are a column of the data
(``foldCol``), so no fold is materialised as a separate copy.
"""

from __future__ import annotations

import hashlib

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import metrics as M


def grid_points(builder_grid: dict) -> list[dict]:
    """Cartesian grid of a small parameter dict (parameter-sized, driver side)."""
    points = [{}]
    for k, values in builder_grid.items():
        points = [dict(p, **{k: v}) for p in points for v in values]
    return points


def random_subset(points: list[dict], n: int, seed: int = 0) -> list[dict]:
    """n grid points chosen by a seeded hash of their description (repeatable)."""
    def h(p):
        return hashlib.md5(f"{sorted(p.items())}:{seed}".encode()).hexdigest()
    return sorted(points, key=h)[:n]


def cross_validate(estimator, grid: list[dict], data: DataFrame, fold_col: str, label: str,
                   parallelism: int = 2):
    """``CrossValidator`` with user folds over just the given points; returns (model, [(point, mean AUC)]).

    ``model.bestModel`` is refitted on all rows with the best point.
    """
    maps = [{estimator.getParam(k): v for k, v in p.items()} for p in grid]
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="probability", metricName="areaUnderROC")
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=ev,
                        foldCol=fold_col, parallelism=parallelism)
    model = cv.fit(data)
    return model, list(zip(grid, model.avgMetrics))


def fold_scores(make_estimator, params: dict, data: DataFrame, fold_col: str, k: int, label: str,
                with_train: bool = False) -> DataFrame:
    """One row per (fold, side) with accuracy, precision, recall, f1 and AUC."""
    out = None
    for f in range(k):
        train, test = data.where(F.col(fold_col) != f), data.where(F.col(fold_col) == f)
        model = make_estimator(**params).fit(train)
        sides = [("test", test)] + ([("train", train)] if with_train else [])
        ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="probability", metricName="areaUnderROC")
        for side, part in sides:
            pred = model.transform(part)
            auc = float(ev.evaluate(pred))  # one distributed job, one number back
            m = M.binary_metrics(pred, label, "prediction", 1.0)
            row = m.select(F.lit(f).alias("fold"), F.lit(side).alias("side"), "accuracy", "precision",
                           "recall", "f1", F.lit(auc).alias("auc"))
            out = row if out is None else out.unionByName(row)
    return out
