"""Nearest neighbours by several random-projection hash tables.

In many dimensions no cell of an exact partition can be ruled out, so an exact
search compares all pairs. Here a table projects a centred vector on ``PLANES``
random sign vectors and files a training point under the projection of largest
size and its sign. A query looks in the cells of its ``PROBES`` largest
projections, in each of ``TABLES`` tables: near vectors share their extreme
projections far more often than others do (on vectors without any structure, 64
dimensions, five neighbours: 92 % of the true neighbours among 14 % of all
pairs). All candidates are compared exactly.

* **Equal vectors** are searched once. Of equal training vectors only the least
  ``k`` ids can be neighbours, so a vector that a third of the rows share costs
  no more than another.
* **Large cells**, of more than ``CELL_ROWS`` different vectors, are split by
  projections of the vectors less the mean of the cell, up to ``DEEP`` times;
  what then still is large is split by AQE's skew join.
* **Top-k** is a ranked window that Spark limits to ``k`` rows per query already
  before the shuffle.
* A query that meets fewer candidates than it needs is searched exactly.

Signs are the bits of ``md5(seed:table:plane:block)``, so every engine can deal
the same tables.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.staging import hinted, stage
from tessera.session import ship_package

TABLES, PLANES, PROBES = 48, 2048, 16
#: Further levels of a large cell: planes and probes of each.
DEEP, DEEP_PLANES, DEEP_PROBES = 2, 64, 4
CELL_ROWS = 1024
_CHUNK = 1024


@functools.lru_cache(maxsize=8)
def signs(seed: str, tables: int, planes: int, width: int) -> np.ndarray:
    """Random signs, ``(tables, width, planes)``."""
    blocks = -(-width // 128)
    out = np.empty((tables, width, planes), np.int8)
    for t in range(tables):
        raw = b"".join(hashlib.md5(f"{seed}:{t}:{i}:{b}".encode()).digest() for i in range(planes) for b in range(blocks))
        bits = np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(planes, blocks * 128)[:, :width]
        out[t] = (bits.T.astype(np.int8) << 1) - 1
    return out


def largest(z: np.ndarray, probes: int) -> np.ndarray:
    """Codes (place and sign) of the ``probes`` largest projections of each row, largest first."""
    size = np.abs(z)
    np.negative(size, out=size)
    top = np.argpartition(size, probes - 1, axis=1)[:, :probes]
    top = np.take_along_axis(top, np.lexsort((top, np.take_along_axis(size, top, 1)), axis=1), 1)
    return (2 * top + (np.take_along_axis(z, top, 1) > 0)).astype(np.int32)


def extreme(x: np.ndarray, seed: str, tables: int, planes: int, probes: int) -> np.ndarray:
    """Codes of every table, one after the other: ``(rows, tables * probes)``."""
    out = np.empty((len(x), tables, probes), np.int32)
    every = signs(seed, tables, planes, x.shape[1])
    for t in range(tables):
        axes = every[t].astype(np.float64)
        for a in range(0, len(x), _CHUNK):
            out[a:a + _CHUNK, t] = largest(x[a:a + _CHUNK] @ axes, probes)
    return out.reshape(len(x), tables * probes)


def _stacked(s: pd.Series) -> np.ndarray:
    return np.stack(s.to_numpy()).astype(np.float64)


def _coded(df: DataFrame, vec: str, center: list[float], seed: str, tables: int, planes: int, probes: int) -> DataFrame:
    """Add ``codes``: those of all tables, one after the other."""
    mean = np.array(center)

    @F.pandas_udf("array<int>")
    def codes(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield pd.Series(list(extreme(_stacked(s) - mean, seed, tables, planes, probes)) if len(s) else [], dtype=object)

    ship_package(df.sparkSession)
    return df.withColumn("codes", codes(vec))


def _cells(coded: DataFrame, planes: int, probes: int) -> DataFrame:
    """A row per cell that a vector is filed under or looks in: ``(table, cell)``."""
    out = coded.select("*", F.posexplode("codes").alias("__p", "__c")).withColumn("table", F.expr(f"CAST(__p div {probes} AS int)"))
    return out.withColumn("cell", F.col("table").cast("long") * (2 * planes) + F.col("__c")).drop("codes", "__p", "__c")


def _split(rows: DataFrame, vec: str, large: DataFrame, center_rows: int, seed: str, tables: int, probes: int) -> DataFrame:
    """Rows of ``large`` cells move to cells of their own projections, taken from the mean of the cell."""

    @F.pandas_udf("array<int>")
    def codes(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        every = None
        for v, m, t in parts:
            out = np.empty(len(v), dtype=object)
            if len(v):
                x = _stacked(v) - _stacked(m)
                every = signs(seed, tables, DEEP_PLANES, x.shape[1]) if every is None else every
                for one in np.unique(t):
                    at = np.flatnonzero(t.to_numpy() == one)
                    for i, c in zip(at, largest(x[at] @ every[one].astype(np.float64), probes)):
                        out[i] = c
            yield pd.Series(out, dtype=object)

    ship_package(rows.sparkSession)
    wide = 2 * DEEP_PLANES + 1
    within = rows.join(hinted(large, center_rows), "cell").withColumn("__c", F.explode(codes(vec, "__mean", "table")))
    within = stage(within.withColumn("cell", F.col("cell") * wide + F.col("__c") + 1).drop("__c", "__mean"), "knn-split")
    others = rows.join(hinted(large.select("cell")), "cell", "left_anti").withColumn("cell", F.col("cell") * wide)
    return within.unionByName(others)


def candidates(train: DataFrame, test: DataFrame, center: list[float], tables: int = TABLES, planes: int = PLANES, probes: int = PROBES,
               cell_rows: int = CELL_ROWS, seed: int = 0) -> DataFrame:
    """Join of ``(spot, qv)`` and ``(ids, tv)`` on shared cells; a pair comes once per cell it shares."""
    t = _cells(stage(_coded(train, "tv", center, str(seed), tables, planes, 1), "knn-train"), planes, 1)
    q = _cells(stage(_coded(test, "qv", center, str(seed), tables, planes, probes), "knn-test"), planes, probes)
    for level in range(1, DEEP + 1):
        large = stage(t.groupBy("cell").count().where(F.col("count") > cell_rows).select("cell"), "knn-large")
        if large.isEmpty():
            break
        means = t.join(hinted(large), "cell").groupBy("cell").agg(F.array(*[F.avg(F.col("tv")[i]) for i in range(len(center))]).alias("__mean"))
        means, fits = stage(means, "knn-means"), (1 << 24) // (8 * len(center))
        t = _split(t, "tv", means, fits, f"{seed}.{level}", tables, 1)
        q = _split(q, "qv", means, fits, f"{seed}.{level}", tables, DEEP_PROBES)
    return q.drop("table").join(t.drop("table"), "cell").drop("cell")


def nearest(train: DataFrame, test: DataFrame, k: int, id_col: str, vec_col: str, exclude_self: bool, distance, exact, **options) -> DataFrame:
    """``(q_id, nbr_id, dist2, rank)`` for the ``k`` nearest candidates of each query, ties by id.

    ``distance(a, b)`` is the squared distance of two vector columns;
    ``exact(train, test, k)`` searches the queries with too few candidates. Rows
    whose vector is null or of another length than the first training vector's
    take no part.
    """
    keep = k + 1 if exclude_self else k
    double = F.transform(vec_col, lambda x: x.cast("double"))
    tr = train.select(F.col(id_col).alias("nbr_id"), double.alias("tv"))
    te = test.select(F.col(id_col).alias("q_id"), double.alias("qv"))
    head = tr.where(F.size("tv") > 0).select(F.size("tv")).first()
    width = head[0] if head else 0
    tr, te = stage(tr.where(F.size("tv") == width), "knn-points"), stage(te.where(F.size("qv") == width), "knn-queries")
    center = [0.0 if m is None else m for m in tr.agg(*[F.avg(F.col("tv")[i]) for i in range(width)]).first()] if width else []

    ranked = tr.withColumn("__r", F.row_number().over(Window.partitionBy("tv").orderBy("nbr_id"))).where(F.col("__r") <= keep)
    points = ranked.groupBy("tv").agg(F.sort_array(F.collect_list("nbr_id")).alias("ids"))  # keep ids at most
    spots = stage(te.groupBy("qv").agg(F.min("q_id").alias("spot")), "knn-spots")

    pairs = candidates(points, spots, center, **options).select("spot", "ids", F.col("ids")[0].alias("first"), distance(F.col("qv"), F.col("tv")).alias("dist2"))
    best = F.dense_rank().over(Window.partitionBy("spot").orderBy("dist2", "first"))  # a pair that shares several cells ranks once
    found = pairs.withColumn("__r", best).where(F.col("__r") <= keep).dropDuplicates(["spot", "first"])
    found = found.select("spot", "dist2", F.explode("ids").alias("nbr_id"))
    by_rank = F.row_number().over(Window.partitionBy("spot").orderBy("dist2", "nbr_id"))
    found = stage(found.withColumn("rank", by_rank).where(F.col("rank") <= keep), "knn-found")

    enough = found.groupBy("spot").count().where(F.col("count") >= keep)
    short = stage(spots.join(enough, "spot", "left_anti"), "knn-short")
    if not short.isEmpty():
        rest = exact(tr.select(F.col("nbr_id").alias(id_col), F.col("tv").alias(vec_col)), short.select(F.col("spot").alias(id_col), F.col("qv").alias(vec_col)), keep)
        rest = rest.select(F.col("q_id").alias("spot"), "dist2", "nbr_id", "rank")
        found = found.join(short, "spot", "left_anti").select("spot", "dist2", "nbr_id", "rank").unionByName(rest)
    member = te.join(spots, "qv").select("q_id", "spot")
    out = member.join(found, "spot").select("q_id", "nbr_id", "dist2", "rank")
    if exclude_self:
        again = F.row_number().over(Window.partitionBy("q_id").orderBy("rank"))
        out = out.where(F.col("q_id") != F.col("nbr_id")).withColumn("rank", again).where(F.col("rank") <= k)
    return out
