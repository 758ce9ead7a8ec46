"""Group statistics attached to rows, profiles with duplicates, samples by Poisson weights."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import profile as A
from tessera.operators import relational as R
from tessera.operators import sampling as S


@pytest.mark.parametrize("few", [1000, 5])
def test_group_rows_by_map_and_by_join(spark, few, monkeypatch):
    monkeypatch.setattr(R, "FEW_GROUPS", few)
    rng = random.Random(1)
    rows = [(None if i % 50 == 0 else "hot" if i % 3 == 0 else f"g{rng.randint(0, 20)}", float(rng.randint(0, 99))) for i in range(2000)]
    out = R.attach_group_row(spark.createDataFrame(rows, "k string, v double"), "k", {"m": F.avg("v"), "n": F.count("*")}).collect()
    assert len(out) == 2000
    for r in out[:300]:
        own = [v for k, v in rows if k == r.k]
        assert r.n == len(own) and r.m == pytest.approx(sum(own) / len(own))


def test_a_few_groups_shuffle_no_rows(spark):
    df = spark.range(10_000).select((F.col("id") % 5).alias("k"), F.col("id").cast("double").alias("v"))
    plan = R.attach_group_row(df, "k", {"m": F.avg("v")}).select("v", "m")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan.split("scalar-subquery")[0]


def test_profile_counts_duplicates_nulls_and_distinct_values(spark):
    rows = [(1, "a", 0.0, [1]), (1, "a", -0.0, [1]), (1, "a", None, None), (1, "a", None, None), (2, "", float("nan"), []), (2, None, float("nan"), []), (2, "1:", 1.5, [1, 2])]
    df = spark.createDataFrame(rows, "i int, s string, d double, x array<int>")
    got = {r.column: r for r in A.profile(df).collect()}
    assert {r.n_duplicates for r in got.values()} == {2} and {r.n_rows for r in got.values()} == {7}
    assert [got[c].n_distinct for c in "isdx"] == [2, 3, 3, 3] and [got[c].n_null for c in "isdx"] == [0, 1, 2, 2]
    none = A.profile(df.limit(0)).collect()
    assert {(r.n_rows, r.n_null, r.n_distinct, r.n_duplicates) for r in none} == {(0, 0, 0, 0)}


def test_poisson_samples(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 10 > 0, F.col("id") % 100).cast("double").alias("v"))
    got = S.mean_of_means(S.poisson_bootstrap_means(df, "id", "v", 40, seed=2))
    assert got.exceptAll(S.mean_of_means(S.poisson_bootstrap_means(df, "id", "v", 40, seed=2))).count() == 0
    rows = got.collect()
    mean, sd = df.agg(F.avg("v"), F.stddev("v")).first()
    error = sd / 18_000 ** 0.5
    assert len(rows) == 40 and abs(rows[0].mean_of_means - mean) < error
    spread = (sum((r.mean - mean) ** 2 for r in rows) / 40) ** 0.5
    assert 0.7 * error < spread < 1.4 * error
    assert sum(S._poisson_steps()[:1]) == pytest.approx(0.36788, abs=1e-5)
