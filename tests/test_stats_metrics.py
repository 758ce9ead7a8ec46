"""Tail probabilities against tabulated values; metrics and splits invariants."""

import math

from pyspark.sql import functions as F

from tessera.functions.distributions import t_pvalue, z_for_level
from tessera.operators import metrics as M
from tessera.operators import sampling as S
from tessera.operators import stats as H


def test_t_distribution_table_values():
    # two-sided 5 % critical values: t(10) = 2.228, t(30) = 2.042
    assert abs(t_pvalue(2.228138851986, 10) - 0.05) < 1e-6
    assert abs(t_pvalue(2.042272456301, 30) - 0.05) < 1e-6
    assert abs(t_pvalue(-1.812461122811, 10, "less") - 0.05) < 1e-6
    assert abs(t_pvalue(0.0, 5) - 1.0) < 1e-12
    assert abs(z_for_level(0.95) - 1.959963984540054) < 1e-9


def test_welch_statistic_by_hand(spark):
    a, b = [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 6.0, 8.0, 10.0]
    df = spark.createDataFrame([("a", x) for x in a] + [("b", x) for x in b], "g string, v double")
    r = H.welch_ttest(df, "v", "g", "a", "b").first()
    va, vb = 5 / 3, 10.0
    t = (2.5 - 6.0) / math.sqrt(va / 4 + vb / 5)
    dof = (va / 4 + vb / 5) ** 2 / ((va / 4) ** 2 / 3 + (vb / 5) ** 2 / 4)
    assert abs(r.t_stat - t) < 1e-12 and abs(r.dof - dof) < 1e-9
    assert 0 < r.p_value < 0.1


def test_auc_with_ties_and_negation(spark):
    rows = [(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1), (1, 0.7), (0, 0.3)]
    df = spark.createDataFrame(rows, "y int, s double")
    auc = M.roc_auc(df, "y", "s").first().auc
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    ref = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(auc - ref) < 1e-12
    neg_auc = M.roc_auc(df.withColumn("s", -F.col("s")), "y", "s").first().auc
    assert abs(neg_auc - (1 - auc)) < 1e-12


def test_confusion_keeps_zero_cells_and_sums(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b")], "y string, p string")
    c = M.confusion(df, "y", "p", ["a", "b", "c"])
    assert c.count() == 9 and c.agg(F.sum("n")).first()[0] == 3


def test_splits_partition_and_repeat(spark):
    df = spark.range(2000).withColumnRenamed("id", "k").withColumn("c", (F.col("k") % 3).cast("int"))
    s1 = S.stratified_split(df, "k", "c", 0.75, seed=1)
    s2 = S.stratified_split(df, "k", "c", 0.75, seed=1)
    assert s1.count() == 2000
    assert s1.exceptAll(s2).count() == 0
    per = s1.groupBy("c").agg(F.count_if(F.col("split") == "train").alias("tr"), F.count("*").alias("n")).collect()
    for r in per:
        assert abs(r.tr - 0.75 * r.n) <= 1


def test_oversample_balances(spark):
    df = spark.createDataFrame([(i, 1 if i < 30 else 0) for i in range(40)], "k long, y int")
    out = S.oversample(df, "k", "y", 0, seed=2)
    counts = {r.y: r["count"] for r in out.groupBy("y").count().collect()}
    assert counts == {1: 30, 0: 30}
