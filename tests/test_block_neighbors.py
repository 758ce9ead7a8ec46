"""Exact nearest neighbours by blocks: all pairs' result, ties, equal vectors, offsets, several blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import block_neighbors as BN
from tessera.operators import neighbors as N

SCHEMA = "id long, v array<double>, label int"


def frame(spark, x):
    return spark.createDataFrame([(i, [float(c) for c in v], 0) for i, v in enumerate(x)], SCHEMA)


def brute(train, queries, k, exclude_self=False):
    out = {}
    for q, v in queries:
        d = sorted((float(np.add.accumulate((v - w) ** 2)[-1]), i) for i, w in train if not (exclude_self and i == q))
        out[q] = [i for _, i in d[:k]]
    return out


def lists(df):
    out = {}
    for r in df.orderBy("q_id", "rank").collect():
        out.setdefault(r.q_id, []).append(r.nbr_id)
    return out


def points(kind, n=400, width=20, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width))
    if kind == "equal":
        x[::3] = x[0]
    elif kind == "grid":  # many equal distances
        x = rng.integers(0, 2, size=(n, width)).astype(float)
    elif kind == "offset":
        x = 1e7 + 1e-3 * x
    elif kind == "outlier":
        x[5] *= 1e9
    return x


@pytest.mark.parametrize("kind", ["plain", "equal", "grid", "offset", "outlier"])
def test_all_neighbours_of_all_pairs(spark, monkeypatch, kind):
    monkeypatch.setattr(BN, "BLOCK_ROWS", 64)
    x = points(kind)
    df, rows = frame(spark, x), list(enumerate(x))
    got = lists(N.knn(df, df, 4, "id", "v", exclude_self=True))
    assert got == brute(rows, rows, 4, True)
    train, test = df.where("id % 4 <> 0"), df.where("id % 4 = 0")
    want = brute([r for r in rows if r[0] % 4], [r for r in rows if not r[0] % 4], 5)
    assert lists(N.knn(train, test, 5, "id", "v")) == want


def test_recall_is_whole_on_the_test_vectors(spark):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    rows = [(r.id, np.array(r.v, float)) for r in e.collect()]
    got = lists(N.knn(e.where("id % 4 <> 0"), e.where("id % 4 = 0"), 5, "id", "v"))
    assert got == brute([r for r in rows if r[0] % 4], [r for r in rows if not r[0] % 4], 5)


def test_tiles_of_one_block_agree_with_one_tile(monkeypatch):
    x, q = points("plain", 700), points("plain", 90, seed=4)
    want = BN.best_in_block(q, x, 3)
    monkeypatch.setattr(BN, "_QUERIES", 16)
    monkeypatch.setattr(BN, "_POINTS", 50)
    assert all((a == b).all() for a, b in zip(want, BN.best_in_block(q, x, 3)))


def test_odd_vectors_take_no_part(spark):
    x = points("plain", 4)
    bad = [(100, None, 0), (101, [1.0, 2.0], 0), (102, [], 0), (103, [float("nan")] * 20, 0), (104, [None] + [1.0] * 19, 0)]
    df = frame(spark, x).unionByName(spark.createDataFrame(bad, SCHEMA))
    got = lists(N.knn(df, df, 6, "id", "v", exclude_self=True))
    assert {q: sorted(v) for q, v in got.items()} == {i: [j for j in range(4) if j != i] for i in range(4)}


@pytest.mark.parametrize("key", ["model_knn", "tune_sweep", "balance_smote", "balance_smote_enn"])
def test_sql_compares_all_pairs(key):
    import __spark_entry__ as E
    assert "md5('0:'" not in E.oracle_sql()[key] and "signs" not in E.oracle_sql()[key]
