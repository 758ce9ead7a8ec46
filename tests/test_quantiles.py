"""Exact quantiles by bucket refinement against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.staging import stage
from tessera.operators import quantiles as Q

PROBS = [0.0, 0.25, 0.777, 1.0]
RNG = np.random.default_rng(3)
SHAPES = {
    "ties": RNG.integers(0, 7, 9000).astype(float), "heavy": RNG.standard_cauchy(9000) ** 3,
    "one value": np.full(4000, 2.5), "magnitudes": np.concatenate([10.0 ** RNG.uniform(-300, 300, 6000), -(10.0 ** RNG.uniform(-300, 300, 3000))]),
    "few": np.array([3.0, 1.0]), "single": np.array([-1.5]), "extremes": np.array([1.7e308, -1.7e308, 0.0, 1.0, 5e-324] * 100),
    "crowded": np.concatenate([[0.0], 1e6 + RNG.random(5000) * 1e-6, [1e9]]),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_shapes(spark, shape, monkeypatch):
    monkeypatch.setattr(Q, "FEW", 50)  # more rounds
    x = SHAPES[shape]
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    got = Q.quantiles(df, "v", PROBS).collect()
    with np.errstate(over="ignore"):
        s = np.sort(x)
        pos = np.array(PROBS) * (len(s) - 1)
        lo, hi = s[np.floor(pos).astype(int)], s[np.ceil(pos).astype(int)]
        want = np.where(pos == np.floor(pos), lo, lo + (hi - lo) * (pos - np.floor(pos)))
    assert len(got) == 1 and np.allclose(list(got[0]), want, rtol=1e-12, atol=0)


@pytest.mark.parametrize("limit", [10_000, 0])
def test_groups_nulls_and_nan(spark, limit, monkeypatch):
    """Groups of all sizes, one of a third of all rows, by refinement and by running counts; NaN is largest."""
    monkeypatch.setattr(Q, "GROUPS", limit)
    monkeypatch.setattr(Q, "FEW", 20)
    rows = [(0 if i % 3 == 0 else int(RNG.integers(1, 40)), float(RNG.normal())) for i in range(4000)]
    odd = [(1, None), (None, 5.0), (50, float("nan")), (51, 1.0), (51, float("nan")), (51, float("nan")), (52, float("inf")), (52, float("-inf")), (52, 0.0)]
    df = spark.createDataFrame(rows + odd, "g int, v double")
    got = {r.g: r for r in Q.quantiles(df, "v", [0.0, 0.25, 0.5, 1.0], ["g"]).collect()}
    assert None not in got
    for g in {g for g, _ in rows}:
        want = np.percentile([v for k, v in rows if k == g], [0, 25, 50, 100])
        assert np.allclose(list(got[g])[1:], want, rtol=1e-12)
    assert all(np.isnan(got[50][1:])) and got[51][1] == 1.0 and np.isnan(got[51][3])
    assert got[52][1] == float("-inf") and got[52][3] == 0.0 and got[52][4] == float("inf")


def test_rest_after_the_last_round(spark, monkeypatch):
    monkeypatch.setattr(Q, "FEW", 2)
    x = np.sort(SHAPES["magnitudes"])
    values = stage(spark.createDataFrame([(0, float(v)) for v in x], "g int, v double"), "test-values")
    wanted = spark.createDataFrame([(0, r, float(x[0]), float(x[-1]), 0) for r in (5, 4500, 8999)], "g int, rank long, a double, b double, below long")
    got = {r["rank"]: r.x for r in Q.select_ranks(values, wanted, ["g"], "v", rounds=1).collect()}
    assert got == {r: x[r] for r in (5, 4500, 8999)}


def test_no_rows_and_no_range_shuffle(spark):
    df = spark.createDataFrame([], "g int, v double")
    assert [tuple(r) for r in Q.quantiles(df, "v", [0.5]).collect()] == [(None,)] and Q.quantiles(df, "v", [0.5], ["g"]).count() == 0
    plan = Q.quantiles(spark.range(5000).select(F.col("id").cast("double").alias("v")), "v", [0.5])
    assert "rangepartitioning" not in plan._jdf.queryExecution().executedPlan().toString()
