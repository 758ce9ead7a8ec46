"""Joins, rankings, top-k and set operations (J, W, U rows).

Join strategy is left to Catalyst and AQE: a side is broadcast at run time
only when its measured size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``;
explicit ``broadcast`` hints are used only on sides whose size is bounded by
construction (one-row aggregates, fixed literal lists).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.ordering import dense_index
from tessera.functions.staging import stage


def group_mean_back(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Mean of ``value`` per key mapped back onto every row.

    Aggregate first (partial aggregation, skew-proof), then an equi join on the
    key; AQE turns it into a broadcast join when the group table is small and
    splits a hot key's partition when it is not.
    """
    means = df.groupBy(*keys).agg(F.avg(value).alias(out))
    return df.join(means, keys, "left")


#: Groups whose statistics may travel as one map.
FEW_GROUPS = 1000


def group_key(col: str) -> Column:
    """Text of a key that a map can hold: null has one of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit(""))


def attach_group_row(df: DataFrame, key: str, aggs: dict[str, Column]) -> DataFrame:
    """Statistics of each row's group as columns; null keys are a group.

    Few groups (counted): their statistics are one map-valued scalar subquery,
    so the rows are neither shuffled nor joined, however unequal the groups.
    More groups: an equi join on the key, whose hot keys AQE splits.
    """
    stats = stage(df.groupBy(key).agg(*[c.alias(n) for n, c in aggs.items()]), "group-rows")
    if stats.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS:
        entry = F.struct(group_key(key).alias("k"), F.struct(*aggs).alias("v"))
        every = stats.agg(F.map_from_entries(F.collect_list(entry)).alias("m")).scalar()  # FEW_GROUPS entries at most
        return df.withColumn("__g", F.try_element_at(every, group_key(key))).withColumns({n: F.col(f"__g.{n}") for n in aggs}).drop("__g")
    right = stats.withColumnRenamed(key, "__key")
    return df.join(right, F.col(key).eqNullSafe(F.col("__key")), "left").drop("__key")


def lookup(df: DataFrame, table: DataFrame, key: str, table_key: str | None = None,
           cols: list[str] | None = None) -> DataFrame:
    """Dictionary map as a left join: misses give NULL."""
    tk = table_key or key
    t = table.select(F.col(tk).alias(key), *(cols or [c for c in table.columns if c != tk]))
    return df.join(t, key, "left")


def semi(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(other.select(*keys), keys, "left_semi")


def anti(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(other.select(*keys), keys, "left_anti")


def row_index(df: DataFrame, order: list[str], out: str = "row_idx", start: int = 0) -> DataFrame:
    """Dense 0-based position in ``order`` (distributed, see ordering.dense_index)."""
    return dense_index(df, order, out, start=start)


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """k first rows of a total order (TakeOrderedAndProject: k rows per task)."""
    return df.orderBy(*order).limit(k)


def both_ends(df: DataFrame, value: str, tie: str, k: int, label: str = "side") -> DataFrame:
    lo = df.orderBy(F.col(value).asc(), F.col(tie).asc()).limit(k).withColumn(label, F.lit("smallest"))
    hi = df.orderBy(F.col(value).desc(), F.col(tie).asc()).limit(k).withColumn(label, F.lit("largest"))
    return lo.unionByName(hi)


def argmin_per_key(df: DataFrame, keys: list[str], score: str, tie: str, cols: list[str]) -> DataFrame:
    """Best (lowest score, then lowest tie) row per key by ``min(struct)``."""
    best = F.min(F.struct(F.col(score), F.col(tie), *[F.col(c) for c in cols if c not in (score, tie)]))
    return df.groupBy(*keys).agg(best.alias("__b")).select(*keys, "__b.*")


def argmax_per_key(df: DataFrame, keys: list[str], score: str, tie: str, cols: list[str]) -> DataFrame:
    """Highest score per key; ties to the lowest ``tie`` value."""
    best = F.max(F.struct(F.col(score), (-F.col(tie)).alias("__neg_tie"), F.col(tie),
                          *[F.col(c) for c in cols if c not in (score, tie)]))
    return df.groupBy(*keys).agg(best.alias("__b")).select(*keys, "__b.*").drop("__neg_tie")


def top_n_per_group(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def first_match(queries: DataFrame, dictionary: DataFrame, keys: list[str], word: str, value: str,
                rank: str) -> DataFrame:
    """Lowest-rank dictionary entry for each query word; words without entry are skipped.

    The dictionary is reduced to one row per word first, so a word with many
    entries meets each query once.
    """
    first = dictionary.groupBy(word).agg(F.min_by(value, rank).alias(value), F.min(rank).alias(rank))
    return queries.join(first, word).groupBy(*keys).agg(F.min_by(value, rank).alias(value))
