"""Hash, distributed numbering, prefix sums and exact quantiles."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions.hashing import portable_hash, wide_hash
from tessera.functions.ordering import dense_index, prefix_sum
from tessera.operators.quantiles import quantiles


def test_portable_hash_is_md5_prefix(spark):
    df = spark.createDataFrame([(k,) for k in (0, 1, 42, 10**12)], "k long")
    got = {r.k: r.h for r in df.select("k", portable_hash("k", seed=7).alias("h")).collect()}
    for k, h in got.items():
        assert h == int(hashlib.md5(f"{k}:7".encode()).hexdigest()[:8], 16)


def _skewed(spark, n=3000):
    rnd = random.Random(3)
    # one key value holds a third of the rows
    rows = [(i, 7 if i % 3 == 0 else rnd.randint(0, 500), float(rnd.randint(0, 50))) for i in range(n)]
    return spark.createDataFrame(rows, "id long, k int, v double")


def test_dense_index_matches_row_number_under_skew(spark):
    df = _skewed(spark)
    got = dense_index(df, ["k", "id"], "idx", n_ranges=8)
    ref = df.withColumn("ref", F.row_number().over(Window.orderBy("k", "id")) - 1)
    j = got.join(ref, "id")
    assert j.where(F.col("idx") != F.col("ref")).count() == 0
    assert got.count() == df.count()


def test_dense_index_plan_has_no_global_window(spark):
    plan = dense_index(_skewed(spark), ["k", "id"], "idx", n_ranges=8)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_prefix_sum(spark):
    df = _skewed(spark)
    got = prefix_sum(df, ["k", "id"], "v", "run", n_ranges=5)
    ref = df.withColumn("ref", F.sum("v").over(Window.orderBy("k", "id").rowsBetween(Window.unboundedPreceding, 0)))
    j = got.join(ref, "id")
    assert j.where(F.abs(F.col("run") - F.col("ref")) > 1e-6).count() == 0


def test_exact_quantiles_match_numpy(spark):
    df = _skewed(spark)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = quantiles(df, "v", probs, names=[f"p{i}" for i in range(len(probs))]).first()
    vals = np.array([r.v for r in df.select("v").collect()])
    for i, p in enumerate(probs):
        assert abs(got[f"p{i}"] - np.percentile(vals, p * 100)) < 1e-9


def test_grouped_quantiles_match_numpy(spark):
    df = _skewed(spark).withColumn("g", F.col("id") % 3)
    got = {r.g: r.med for r in quantiles(df, "v", [0.5], ["g"], ["med"]).collect()}
    pdf = df.toPandas()
    for g, sub in pdf.groupby("g"):
        assert abs(got[g] - np.percentile(sub.v, 50)) < 1e-9


def test_quantiles_of_empty_and_single(spark):
    one = spark.createDataFrame([(5.0,)], "v double")
    assert quantiles(one, "v", [0.25, 0.75], names=["a", "b"]).first().asDict() == {"a": 5.0, "b": 5.0}


@pytest.mark.parametrize("n_ranges", [8, 200, 1000])
def test_dense_index_orders_nan_null_and_mixed_keys_at_any_number_of_ranges(spark, n_ranges):
    import datetime
    rows = [(i, None if i % 11 == 0 else float("nan") if i % 5 == 0 else float((i * 7) % 900), f"k{(i * 7) % 13:02d}",
             datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=(i * 37) % 500)) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, v double, s string, ts timestamp")
    for keys in (["v", "id"], ["ts", "s", "id"]):
        got = {r.id: r.idx for r in dense_index(df, keys, "idx", n_ranges=n_ranges).collect()}
        ref = {r.id: r.ref for r in df.withColumn("ref", F.row_number().over(Window.orderBy(*keys)) - 1).collect()}
        assert got == ref


def test_dense_index_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id long, v double")
    assert dense_index(df, ["v", "id"], "idx", n_ranges=8).columns == ["id", "v", "idx"]
    assert dense_index(df, ["v", "id"], "idx", n_ranges=8).count() == 0


def test_sample_n_takes_the_smallest_hashes(spark):
    from tessera.operators import sampling as S
    df = spark.range(3000).withColumnRenamed("id", "k")
    order = [r.k for r in df.orderBy(wide_hash("k", seed=3), "k").collect()]
    for n in (0, 1, 1200, 2999, 3000, 5000):
        assert {r.k for r in S.sample_n(df, "k", n, seed=3).collect()} == set(order[:n])


def test_closure_of_a_deep_chain_and_a_cycle(spark):
    from tessera.operators.taxonomy import closure
    chain = spark.createDataFrame([(i, i + 1) for i in range(80)], "child int, parent int")
    assert closure(chain).count() == 81 * 82 // 2
    cycle = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "child int, parent int")
    assert {tuple(r) for r in closure(cycle).collect()} == {(a, b, (b - a) % 3) for a in (1, 2, 3) for b in (1, 2, 3)}


def test_dates_with_hyphens_and_decoys(spark):
    from tessera.functions.dates import extract_date
    want = {"Mar-20-2009": "2009-03-20", "Mar.20, 2009": "2009-03-20", "20-Mar-2009": "2009-03-20", "March 20th, 2009": "2009-03-20",
            "summary 2009": "2009-01-01", "decided 1998": "1998-01-01", "Feb 2009": "2009-02-01", "4/20/09": "1909-04-20", "6/2008": "2008-06-01"}
    df = spark.createDataFrame([(k,) for k in want], "t string")
    from pyspark.sql import functions as F
    got = {r["t"]: r["d"] for r in df.select("t", F.date_format(extract_date("t"), "yyyy-MM-dd").alias("d")).collect()}
    assert got == want
