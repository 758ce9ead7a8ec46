"""Nearest neighbours by hash tables: recall and work against all pairs, hot vectors, split cells, complete SMOTE."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.staging import stage
from tessera.operators import hashed_neighbors as HN
from tessera.operators import neighbors as N

SCHEMA = "id long, v array<double>, label int"


def frame(spark, x, ids=None):
    return spark.createDataFrame([(int(i), [float(c) for c in v], 0) for i, v in zip(ids if ids is not None else range(len(x)), x)], SCHEMA)


#: Fewer and smaller tables do for clustered vectors.
SMALL = {"tables": 12, "planes": 128, "probes": 4}


def search(df, queries, k, **options):
    exact = lambda tr, te, n: N.knn_exact(tr, te, n, "id", "v")
    return lists(HN.nearest(df, queries, k, "id", "v", True, N.sq_dist, exact, **{**SMALL, **options}))


def brute(train, queries, k, exclude_self=False):
    """{query: [ids]} over all pairs, ties by id; both sides are (id, vector) lists."""
    out = {}
    for q, v in queries:
        d = sorted((float(((v - w) ** 2).sum()), i) for i, w in train if not (exclude_self and i == q))
        out[q] = [i for _, i in d[:k]]
    return out


def lists(df):
    out = {}
    for r in df.orderBy("q_id", "rank").collect():
        out.setdefault(r.q_id, []).append(r.nbr_id)
    return out


def recall(got, want):
    return sum(len(set(got[q]) & set(w)) for q, w in want.items()) / sum(map(len, want.values()))


def test_recall_and_pairs_on_the_test_vectors(spark):
    """Vectors without structure, the hard case: nine tenths of the neighbours among less than a fifth of all pairs."""
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in e.collect()]
    train, test = [r for r in rows if r[0] % 4], [r for r in rows if not r[0] % 4]
    as_df = lambda part: frame(spark, [v for _, v in part], [i for i, _ in part])
    tr, te = as_df(train), as_df(test)
    got = lists(N.knn(tr, te, 5, "id", "v"))
    assert recall(got, brute(train, test, 5)) >= 0.9
    assert {len(x) for x in got.values()} == {5}
    center = np.mean([v for _, v in train], axis=0).tolist()
    met = stage(HN.candidates(tr.select(F.array("id").alias("ids"), F.col("v").alias("tv")),
                              te.select(F.col("id").alias("spot"), F.col("v").alias("qv")), center).select("spot", "ids"), "test-pairs")
    assert met.count() < 0.2 * len(train) * len(test)
    assert met.distinct().count() < 0.16 * len(train) * len(test)


def clusters(n=600, width=24, groups=40, seed=1):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(groups, width))[rng.integers(0, groups, n)] * 4 + rng.normal(size=(n, width)) * 0.3


def test_clustered_vectors_are_found_whole(spark):
    x = clusters()
    df = frame(spark, x)
    rows = list(enumerate(x))
    assert recall(search(df, df, 4), brute(rows, rows, 4, True)) > 0.95


def test_equal_vectors_cost_no_pairs(spark):
    """A third of the rows share one vector: neighbours are the least ids, and pairs do not grow with the group."""
    x = clusters(900)
    x[::3] = x[0]
    df, rows = frame(spark, x), list(enumerate(x))
    got = search(df, df, 4)
    want = brute(rows, rows, 4, True)
    assert all(got[i] == want[i] for i in range(0, 900, 3))
    assert recall(got, want) > 0.95


@pytest.mark.parametrize("cell_rows", [4])
def test_large_cells_are_split(spark, cell_rows):
    x = clusters(1500, groups=5)
    df, rows = frame(spark, x), list(enumerate(x))
    queries = df.where("id % 10 = 0")
    got = search(df, queries, 3, cell_rows=cell_rows)
    want = brute(rows, [r for r in rows if r[0] % 10 == 0], 3, True)
    assert {q: len(v) for q, v in got.items()} == {q: 3 for q in want}
    assert recall(got, want) > 0.4
    args = (df.select(F.array("id").alias("ids"), F.col("v").alias("tv")), queries.select(F.col("id").alias("spot"), F.col("v").alias("qv")), [0.0] * 24)
    assert HN.candidates(*args, cell_rows=cell_rows, **SMALL).count() < 0.25 * HN.candidates(*args, **SMALL).count()


def test_few_points_and_odd_vectors(spark):
    x = clusters(4)
    odd = spark.createDataFrame([(100, None, 0), (101, [1.0, 2.0], 0), (102, [], 0)], SCHEMA)
    df = frame(spark, x).unionByName(odd)
    got = lists(N.knn(df, df, 6, "id", "v", exclude_self=True))
    assert {q: sorted(v) for q, v in got.items()} == {i: [j for j in range(4) if j != i] for i in range(4)}
    none = df.where("id < 0")
    assert N.knn(none, df, 3, "id", "v").count() == 0 and N.knn(df, none, 3, "id", "v").count() == 0


@pytest.mark.parametrize("n", [1, 4])
@pytest.mark.parametrize("width", [3, 20])
def test_smote_makes_every_row_asked_for(spark, n, width):
    mino = frame(spark, clusters(n, width=width, groups=2))
    got = N.smote(mino, 100, 5, "id", "v").collect()
    assert sorted(r.synthetic_id for r in got) == list(range(100))
    assert all((r.base_id != r.nbr_id) == (n > 1) for r in got)
    assert N.smote(mino.where("id < 0"), 10, 5, "id", "v").count() == 0


def test_signs_are_the_bits_of_md5():
    import hashlib
    s = HN.signs("7", 2, 3, 130)
    h = hashlib.md5(b"7:1:2:1").hexdigest()
    assert [int(v > 0) for v in s[1, 128:, 2]] == [(int(h[0], 16) >> 3) & 1, (int(h[0], 16) >> 2) & 1]
