"""Operators keyed by a value that holds a third of all rows stay correct
(hot groups go through partial aggregation or AQE's skew-join split)."""

import random

from pyspark.sql import functions as F

from tessera.operators import clean as C
from tessera.operators import relational as R
from tessera.operators.profile import box_stats


def _hot(spark, n=6000):
    rnd = random.Random(5)
    rows = [(i, 0 if i % 3 == 0 else rnd.randint(1, 200), float(rnd.randint(0, 1000)), f"t{rnd.randint(0, 50)}")
            for i in range(n)]
    return spark.createDataFrame(rows, "id long, k int, v double, s string")


def test_group_mean_back_hot_key(spark):
    df = _hot(spark)
    got = R.group_mean_back(df, ["k"], "v", "m")
    pdf = df.toPandas()
    ref = pdf.groupby("k").v.mean()
    for r in got.where(F.col("k").isin(0, 1, 2)).select("k", "m").distinct().collect():
        assert abs(r.m - ref[r.k]) < 1e-9
    assert got.count() == df.count()


def test_dedup_and_argmin_hot_key(spark):
    df = _hot(spark)
    d = C.dedup_first(df, ["k"], "id")
    pdf = df.toPandas()
    assert {r.k: r.id for r in d.collect()} == pdf.groupby("k").id.min().to_dict()
    a = R.argmin_per_key(df, ["k"], "v", "id", ["id", "v"])
    ref = pdf.sort_values(["v", "id"]).groupby("k").head(1).set_index("k").id.to_dict()
    assert {r.k: r.id for r in a.collect()} == ref


def test_box_stats_hot_group(spark):
    import numpy as np
    df = _hot(spark).withColumn("g", (F.col("k") == 0).cast("int"))
    got = {r.g: r for r in box_stats(df, "v", ["g"]).collect()}
    pdf = df.toPandas()
    for g, sub in pdf.groupby("g"):
        q1, med, q3 = np.percentile(sub.v, [25, 50, 75])
        assert abs(got[g].q1 - q1) < 1e-9 and abs(got[g].median - med) < 1e-9 and abs(got[g].q3 - q3) < 1e-9
        inside = sub.v[(sub.v >= q1 - 1.5 * (q3 - q1)) & (sub.v <= q3 + 1.5 * (q3 - q1))]
        assert got[g].n_outliers == len(sub) - len(inside)
