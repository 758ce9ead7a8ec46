"""Whitening: against a full eigendecomposition, exact integers, and vectors that cannot be used."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.conftest import SF_SMALL

from tessera.llm import whitening
from tessera.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def grid(vectors):
    return [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]


def check(got, ids, vectors, wanted=32):
    """Rows of the operator against numpy on the same integers."""
    x = grid(vectors)
    n, sums = len(x), [sum(c) for c in zip(*x)]
    a = (np.array(x, dtype=object) * n - np.array(sums, dtype=object)).astype(np.float64) / n
    values, axes = np.linalg.eigh(a.T @ a / n)
    values, axes = values[::-1], axes[:, ::-1]
    m = min(wanted, int((values > 1e-13 * values.sum()).sum()))
    rows = sorted(got.collect(), key=lambda r: (r.vec_id, r.component))
    assert [(r.vec_id, r.component) for r in rows] == [(i, c) for i in sorted(ids) for c in range(1, m + 1)]
    z = np.array([r.whitened for r in rows]).reshape(n, m)
    order = np.argsort(ids)
    for c in range(m):
        want = (a @ axes[:, c] / math.sqrt(values[c]))[order]
        gap = min([abs(values[c] - v) for i, v in enumerate(values) if i != c], default=1.0)
        if gap > 1e-6 * values[0]:
            assert min(np.abs(z[:, c] - want).max(), np.abs(z[:, c] + want).max()) < 1e-7
    exact = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    assert {(r.vec_id, r.deviation) for r in rows} == set(zip(ids, exact)) and {r.n for r in rows} == {n}
    assert np.allclose([r.explained for r in rows[:m]], values[:m] / values.sum(), rtol=1e-9)
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and rows[0].identity_error < 1e-9
    assert np.abs(np.cov(z.T, bias=True).reshape(m, m) - np.eye(m)).max() < 1e-9


def rows_of(vectors):
    return [(i, [float(c) for c in v], 0) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("make", [
    lambda r: r.standard_normal((300, 48)), lambda r: r.standard_normal((20, 40)), lambda r: r.standard_normal((200, 5)) @ r.standard_normal((5, 24)),
    lambda r: r.standard_normal((400, 6)) * np.array([1e3, 50, 8, 1, 0.3, 0.1]) + 5000, lambda r: np.repeat(r.standard_normal((30, 12)), 5, axis=0),
    lambda r: r.standard_normal((50, 1))])
def test_against_eigendecomposition(spark, make):
    vectors = make(np.random.default_rng(4)).astype(np.float32)
    check(whitening.whiten(spark.createDataFrame(rows_of(vectors), SCHEMA).repartition(3)), list(range(len(vectors))), vectors)


def test_equal_deviations(spark):
    """Equal eigenvalues exhaust the space of one start; every direction is found all the same."""
    vectors = np.vstack([np.eye(12), -np.eye(12)]) * 4
    got = whitening.whiten(spark.createDataFrame(rows_of(vectors), SCHEMA))
    check(got, list(range(24)), vectors)
    assert got.select("component").distinct().count() == 12


def test_given_table(spark):
    e = table(spark, SF_SMALL, "embeddings")
    rows = e.collect()
    check(whitening.whiten(e), [r.vec_id for r in rows], [r.embedding for r in rows])


def test_unusable_vectors(spark):
    good = rows_of(np.random.default_rng(1).standard_normal((40, 3)))
    bad = [(100, None, 1), (101, [1.0, None, 2.0], 1), (102, [float("nan"), 1.0, 1.0], 1), (103, [float("inf"), 0.0, 0.0], 1), (104, [], 1), (105, [1.0, 2.0], 1),
           (106, [1e30, 0.0, 0.0], 1)]
    df = spark.createDataFrame(good + bad, SCHEMA)
    check(whitening.whiten(df), [r[0] for r in good], [r[1] for r in good])
    clash = df.withColumns({c: F.lit("z") for c in ("key", "keys", "rows", "x", "i", "v", "n", "component", "whitened")})
    check(whitening.whiten(clash), [r[0] for r in good], [r[1] for r in good])


def test_nothing_to_whiten(spark):
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None, 0)], [(1, [1.0, 2.0], 0)], [(i, [1.0, 2.0], 0) for i in range(5)]):
        got = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
        assert got.columns == names and got.collect() == []


def test_null_and_repeated_keys(spark):
    vectors = np.random.default_rng(2).standard_normal((30, 2))
    got = whitening.whiten(spark.createDataFrame([(None if i < 10 else 7, [float(c) for c in v], 0) for i, v in enumerate(vectors)], SCHEMA))
    assert got.where("vec_id IS NULL").count() == 20 and got.where("vec_id = 7").count() == 40


def test_deviation_is_exact_or_null():
    x = np.array([[2_000_000, 0], [0, 0]], dtype=np.int64)
    n, total = 3_000_000_000, np.array([5, 7], dtype=np.int64)
    want = [sum((int(c) * n - int(t)) ** 2 for c, t in zip(row, total)) for row in x]
    assert whitening.deviations(x, n, total) == [w if w < 1 << 63 else None for w in want]
