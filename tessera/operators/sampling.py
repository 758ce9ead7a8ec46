"""Seeded sampling, splitting and class balance (R rows).

Every random decision is ``H(key:seed)`` (see functions.hashing): a row decides
its own fate, so splits need no shuffle, are repeatable after a lost
executor, and match any engine that can compute md5.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tessera.functions.subquery import attach_row

from tessera.functions.hashing import HASH_SPACE, WIDE_SPACE, portable_hash, wide_hash
from tessera.functions.ordering import dense_index

SCALE = 1_000_000


def sample_n(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows without replacement: the n smallest ``(H, key)`` (the limit is the feature).

    A threshold on H, from the row count, leaves a few more rows than n; their
    distributed numbering trims them exactly. If the threshold left too few, it
    is doubled. Counting is eager; fewer rows than n are all returned.
    """
    total = df.count()
    if n >= total:
        return df
    h = df.withColumn("__h", wide_hash(key, seed=seed))
    share = (n + 6 * math.sqrt(n) + 20) / total
    near = h
    while share < 1:
        near = h.where(F.col("__h") < int(share * WIDE_SPACE))
        if near.count() >= n:
            break
        near, share = h, 2 * share
    return dense_index(near, ["__h", key], "__i").where(F.col("__i") < n).drop("__h", "__i")


def draws_with_replacement(df: DataFrame, key: str, n_draws: int, seed: int = 0,
                           draw_ids: DataFrame | None = None) -> DataFrame:
    """``n_draws`` rows drawn with replacement: draw j takes the row at dense
    position ``H(j:seed) mod N`` (60 bits of H). Joins on the position, so no row list is
    gathered anywhere."""
    spark = df.sparkSession
    pop = dense_index(df, [key], "__idx")
    n = df.count()
    draws = draw_ids if draw_ids is not None else spark.range(n_draws).withColumnRenamed("id", "draw")
    draws = draws.withColumn("__idx", wide_hash("draw", seed=seed) % F.lit(n))
    return draws.join(pop, "__idx").drop("__idx")


def bootstrap_means(df: DataFrame, key: str, value: str, n_samples: int, sample_size: int,
                    seed: int = 0) -> DataFrame:
    """Mean of each of ``n_samples`` bootstrap samples of ``sample_size`` rows."""
    spark = df.sparkSession
    ids = (spark.range(n_samples * sample_size)
           .select((F.col("id") / sample_size).cast("long").alias("sample"), (F.col("id") % sample_size).alias("j"))
           .withColumn("draw", F.concat_ws(":", F.col("sample").cast("string"), F.col("j").cast("string"))))
    d = draws_with_replacement(df.select(key, value), key, 0, seed, ids)
    return d.groupBy("sample").agg(F.avg(value).alias("mean"))


def _poisson_steps(tail: float = 1e-12) -> list[float]:
    """Cumulative probabilities of a Poisson(1) count: a uniform draw has as many as it reaches."""
    steps, p, total, k = [], math.exp(-1.0), 0.0, 0
    while 1.0 - total > tail:
        total += p
        steps.append(total)
        k += 1
        p /= k
    return steps[:-1]


def poisson_bootstrap_means(df: DataFrame, key: str, value: str, n_samples: int, seed: int = 0) -> DataFrame:
    """``(sample, mean)`` of bootstrap samples as large as the table, in one scan.

    A row is in a sample as often as a Poisson(1) draw by the hash of its key and
    the sample says, which needs no join: each task sums its rows for every
    sample. Null values do not count; a sample that drew no row has a null mean.
    """
    rows = df.where(F.col(value).isNotNull()).select(key, F.col(value).cast("double").alias("__v"), F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1))).alias("sample"))
    u = portable_hash(key, "sample", seed=seed) / F.lit(float(HASH_SPACE))
    weight = F.lit(0)
    for step in _poisson_steps():
        weight = weight + (u >= F.lit(step)).cast("int")
    sums = rows.withColumn("__w", weight).groupBy("sample").agg(F.sum(F.col("__w") * F.col("__v")).alias("__s"), F.sum("__w").alias("__n"))
    return sums.select("sample", F.try_divide("__s", "__n").alias("mean"))


def mean_of_means(means: DataFrame) -> DataFrame:
    """``means`` with ``mean_of_means``, the average over all its samples."""
    return attach_row(means, means.agg(F.avg("mean").alias("mean_of_means")))


def hash_split(df: DataFrame, key: str, shares: list[float], names: list[str], seed: int = 0,
               col: str = "split") -> DataFrame:
    """Assign ``names[i]`` by cumulative ``shares`` of ``H(key:seed) mod 10^6``."""
    u = portable_hash(key, seed=seed) % SCALE
    out, acc = None, 0.0
    for share, name in zip(shares[:-1], names[:-1]):
        acc += share
        cond = u < int(round(acc * SCALE))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    out = F.lit(names[-1]) if out is None else out.otherwise(F.lit(names[-1]))
    return df.withColumn(col, out)


def rank_within_class(df: DataFrame, key: str, label: str, seed: int = 0, out: str = "__rank") -> DataFrame:
    """0-based rank of each row inside its class by ``(H, key)``: one
    distributed numbering over ``(label, H, key)`` minus the class offset."""
    h = df.withColumn("__h", portable_hash(key, seed=seed))
    idx = dense_index(h, [label, "__h", key], "__g")
    start = idx.groupBy(label).agg(F.min("__g").alias("__s"), F.count(F.lit(1)).alias("__nc"))
    return idx.join(start, label).withColumn(out, F.col("__g") - F.col("__s")).drop("__g", "__s", "__h")


def stratified_split(df: DataFrame, key: str, label: str, train_share: float, seed: int = 0,
                     col: str = "split") -> DataFrame:
    """Each class keeps ``round(share * n_class)`` rows (half up) on the train side."""
    r = rank_within_class(df, key, label, seed)
    cut = F.floor(F.col("__nc") * train_share + 0.5)
    return r.withColumn(col, F.when(F.col("__rank") < cut, "train").otherwise("test")).drop("__rank", "__nc")


def kfold(df: DataFrame, key: str, k: int, seed: int = 0, label: str | None = None, col: str = "fold") -> DataFrame:
    if label is None:
        return df.withColumn(col, (portable_hash(key, seed=seed) % k).cast("int"))
    r = rank_within_class(df, key, label, seed)
    return r.withColumn(col, (F.col("__rank") % k).cast("int")).drop("__rank", "__nc")


def undersample(df: DataFrame, key: str, label: str, majority, ratio: float, seed: int = 0) -> DataFrame:
    """Majority cut to ``ceil(n_minority / ratio)`` rows (smallest hashes) + all other rows."""
    n_min = df.where(F.col(label) != F.lit(majority)).count()
    keep = math.ceil(n_min / ratio)
    maj = sample_n(df.where(F.col(label) == F.lit(majority)), key, keep, seed)
    return maj.unionByName(df.where(F.col(label) != F.lit(majority)))


def oversample(df: DataFrame, key: str, label: str, minority, seed: int = 0) -> DataFrame:
    """Minority redrawn with replacement up to the majority size, plus the majority."""
    maj = df.where(F.col(label) != F.lit(minority))
    mino = df.where(F.col(label) == F.lit(minority))
    n_maj = maj.count()
    up = draws_with_replacement(mino, key, n_maj, seed).drop("draw")
    return maj.unionByName(up.select(*df.columns))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``N / (n_classes * n_class)`` per class."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    tot = c.agg(F.sum("__n").alias("__total"), F.count(F.lit(1)).alias("__k"))  # one row
    return attach_row(c, tot).select(label, (F.col("__total") / (F.col("__k") * F.col("__n"))).alias("weight"))
