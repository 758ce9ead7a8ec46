"""Categorical columns of any number of levels.

The levels of a column are a table ``(level, idx)``, numbered densely in their
order; encoding is a join. A dummy matrix is kept as its ones: a wide frame needs
a column per level, which only a caller who knows the levels can want.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.ordering import dense_index
from tessera.functions.staging import hinted, stage


def level_table(df: DataFrame, col: str) -> DataFrame:
    """``(level, idx)`` of the distinct non-null values, numbered from 0 in ascending order."""
    levels = df.select(F.col(col).alias("level")).where("level IS NOT NULL").distinct()
    return stage(dense_index(levels, ["level"], "idx"), "levels")


def level_index(df: DataFrame, col: str, levels: DataFrame, out: str) -> DataFrame:
    """``df`` with the number of its level, null for null and for levels that are not in the table."""
    table = hinted(levels.select(F.col("level").alias("__level"), F.col("idx").alias(out)))
    return df.join(table, F.col(col) == F.col("__level"), "left").drop("__level")


def dummies_long(df: DataFrame, keys: list[str], col: str, levels: DataFrame | None = None, drop_first: bool = False) -> DataFrame:
    """The ones of the dummy matrix: ``(keys, level, idx)``.

    ``idx`` is the dummy column, so with ``drop_first`` the first level has no
    row and the second is column 0. Null and unknown levels have no row.
    """
    levels = level_table(df, col) if levels is None else levels
    ones = level_index(df.select(*keys, F.col(col).alias("level")), "level", levels, "idx").where("idx IS NOT NULL")
    first = 1 if drop_first else 0
    return ones.where(F.col("idx") >= first).withColumn("idx", F.col("idx") - first)


def onehot(train: DataFrame, test: DataFrame, col: str, out: str, drop_first: bool = True) -> DataFrame:
    """Sparse one-hot vector learned on ``train``: ``struct<size, indices, values>`` for every row of ``test``.

    Levels unseen in training, nulls and (with ``drop_first``) the first level
    are the all-zero vector, as dummy coding with an ignored unknown does.
    """
    levels = level_table(train, col)
    first = 1 if drop_first else 0
    size = max(0, levels.count() - first)
    at = F.col("__idx") - first
    some = at >= 0
    vec = F.struct(F.lit(size).alias("size"), F.when(some, F.array(at)).otherwise(F.array().cast("array<bigint>")).alias("indices"),
                   F.when(some, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"))
    return level_index(test, col, levels, "__idx").withColumn(out, vec).drop("__idx")


def cell_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """``(a, b, n)`` of the pairs of values that occur."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def full_grid(df: DataFrame, a: str, b: str, more: list | None = None) -> DataFrame:
    """``cell_counts`` with a row for every pair of classes of either column (and of ``more``), zero where it does not occur.

    The square of the number of classes is what is asked for; the classes are
    numbered and each is paired with a run of numbers, so no list of them is
    ever in one place.
    """
    every = df.select(F.col(a).alias("c")).union(df.select(F.col(b).alias("c")))
    if more:
        every = every.union(df.sparkSession.createDataFrame([(c,) for c in more], every.schema))
    classes = level_table(every, "c")
    n = classes.count()
    rows = classes.select(F.col("level").alias(a), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))).alias("idx")) if n else classes.select(F.col("level").alias(a), "idx")
    grid = rows.join(classes.select("idx", F.col("level").alias(b)), "idx").select(a, b)
    return grid.join(cell_counts(df, a, b), [a, b], "left").select(a, b, F.coalesce("n", F.lit(0)).alias("n"))
