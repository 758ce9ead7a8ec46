"""Exact kNN (pivot-cell pruning) against brute force, SMOTE and ENN invariants."""

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import neighbors as N


def _points(spark, n=300, dim=6, seed=0):
    rng = np.random.RandomState(seed)
    x = rng.normal(size=(n, dim))
    x[: n // 3] = 0.01 * rng.normal(size=(n // 3, dim))  # a crowded region: one hot cell
    labels = rng.randint(0, 3, size=n)
    rows = [(int(i), [float(v) for v in x[i]], int(labels[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, v array<double>, label int"), x, labels


def test_knn_is_exact(spark):
    df, x, _ = _points(spark)
    train, test = df.where(F.col("id") % 4 != 0), df.where(F.col("id") % 4 == 0)
    got = N.knn(train, test, 5, "id", "v", n_pivots=6)
    got = {(r.q_id, r.rank): r.nbr_id for r in got.collect()}
    tr_ids = [i for i in range(len(x)) if i % 4 != 0]
    for q in range(0, len(x), 4):
        d = sorted((float(((x[q] - x[j]) ** 2).sum()), j) for j in tr_ids)
        assert [got[(q, r)] for r in range(1, 6)] == [j for _, j in d[:5]]


def test_knn_fewer_points_than_k_in_cells(spark):
    df, x, _ = _points(spark, n=40)
    got = N.knn(df, df, 3, "id", "v", n_pivots=12, exclude_self=True)
    assert got.count() == 40 * 3
    assert got.where(F.col("q_id") == F.col("nbr_id")).count() == 0


def test_smote_points_lie_on_segments(spark):
    df, _, _ = _points(spark, n=60)
    mino = df.where(F.col("label") == 0)
    s = N.smote(mino, 25, 3, "id", "v", seed=4, n_pivots=4)
    assert s.count() == 25
    vec = {r.id: np.array(r.v) for r in mino.collect()}
    for r in s.collect():
        a, b = vec[r.base_id], vec[r.nbr_id]
        assert 0.0 <= r.u < 1.0
        assert np.allclose(np.array(r.v), a + r.u * (b - a))
    s2 = N.smote(mino, 25, 3, "id", "v", seed=4, n_pivots=4)
    assert s.exceptAll(s2).count() == 0  # same seed, same rows


def test_enn_keeps_only_agreeing_rows(spark):
    df, x, labels = _points(spark, n=80)
    kept = {r.id for r in N.enn_filter(df, "id", "v", "label", k=3, n_pivots=5).collect()}
    for i in range(len(x)):
        d = sorted((float(((x[i] - x[j]) ** 2).sum()), j) for j in range(len(x)) if j != i)
        agree = all(labels[j] == labels[i] for _, j in d[:3])
        assert (i in kept) == agree
