"""Categorical columns of many levels, and curves of many groups in one pass."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.functions.ordering import keyed_prefix_sums
from tessera.operators import categories as K
from tessera.operators import metrics as M


def test_a_million_levels_encode(spark):
    df = spark.range(0, 1_200_000).select("id", F.concat(F.lit("v"), F.lpad((F.col("id") % 1_000_000).cast("string"), 7, "0")).alias("c"))
    ones = K.dummies_long(df, ["id"], "c", drop_first=True)
    got = ones.agg(F.count("*"), F.min("idx"), F.max("idx"), F.count_if(F.col("idx") != F.substring("level", 2, 7).cast("long") - 1)).first()
    assert got[:] == (1_200_000 - 2, 0, 999_998, 0)
    hot = K.onehot(df, df.where("id < 3").unionByName(spark.createDataFrame([(9, "new"), (8, None)], "id long, c string")), "c", "vec", drop_first=False)
    assert {(r.id, r.vec.size, tuple(r.vec.indices)) for r in hot.collect()} == {(0, 1_000_000, (0,)), (1, 1_000_000, (1,)), (2, 1_000_000, (2,)), (9, 1_000_000, ()), (8, 1_000_000, ())}


def test_figures_of_many_classes(spark):
    rng = random.Random(1)
    rows = [(f"c{rng.randint(0, 1500)}", f"c{rng.randint(0, 1500)}") for _ in range(4000)] + [("a", "a"), ("a", None), (None, "b")]
    df = spark.createDataFrame(rows, "y string, p string")
    got = {r["class"]: r for r in M.per_class(df, "y", "p").collect()}
    assert set(got) == {c for r in rows for c in r} - {None} and len(got) > 1000
    assert (got["a"].precision, got["a"].recall, got["a"].support) == (1.0, 0.5, 2) and got["b"].support == 0
    some = rows[0][0]
    assert got[some].recall == sum(y == p == some for y, p in rows) / sum(y == some for y, _ in rows)
    assert M.confusion(df, "y", "p", zeros=False).agg(F.sum("n")).first()[0] == len(rows)


def test_grid_of_an_empty_table(spark):
    none = spark.createDataFrame([], "y string, p string")
    assert M.confusion(none, "y", "p").count() == 0 and M.per_class(none, "y", "p").count() == 0


def test_curves_by_group(spark):
    """Groups of all sizes, one of them holding a third of all rows, equal the curve of each group alone."""
    rng = random.Random(2)
    rows = [("hot" if i % 3 == 0 else f"g{rng.randint(0, 30)}", rng.randint(0, 1), rng.randint(0, 40) / 40) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, y int, s double")
    auc = {r.g: r.auc for r in M.roc_auc(df, "y", "s", by=["g"]).collect()}
    points = {}
    for r in M.roc_curve(df, "y", "s", by=["g"]).collect():
        points.setdefault(r.g, {})[r.threshold] = (r.fpr, r.tpr)
    for g in ("hot", "g0", "g7"):
        pos, neg = [s for k, y, s in rows if k == g and y], [s for k, y, s in rows if k == g and not y]
        assert auc[g] == pytest.approx(sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg))
        assert points[g] == {t: (sum(s >= t for s in neg) / len(neg), sum(s >= t for s in pos) / len(pos)) for t in set(pos + neg)}
    run = keyed_prefix_sums(df.withColumn("n", F.lit(1).cast("long")).withColumn("id", F.monotonically_increasing_id()), ["g"], ["s", "id"], {"at": "n"})
    assert run.groupBy("g").agg((F.max("at") == F.count("*")).alias("ok"), (F.min("at") == 1).alias("first")).where("NOT ok OR NOT first").count() == 0
