"""Exact nearest neighbours among all pairs, block by block.

Training points and queries are dealt into blocks by a hash of their id. A task
gets one block of each and runs through the pairs in tiles: one matrix product of
single precision bounds the squared distances of a tile from below, and only
pairs whose bound does not exceed the query's k-th best distance so far are
computed in double precision, summed in index order. A pair is ruled out only by
its bound, so the result is that of all pairs, whatever the vectors are.

A task holds two blocks and one tile at any table size. Each side is sent once
for every block of the other, so shuffled bytes grow with the number of blocks;
a block is as large as ``BLOCK_BYTES`` allows, smaller where that would leave
cores without work.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pac
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.staging import stage
from tessera.session import ship_package

#: Bytes of the double vectors of a block, and the fewest rows worth a block of their own.
BLOCK_BYTES, BLOCK_ROWS = 32 << 20, 1024
#: Pairs of blocks for each core, where the table has as many.
PAIRS_PER_CORE = 4
_QUERIES, _POINTS = 512, 8192


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(flat), -1)


def exact_dist2(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of paired rows, summed in index order as ``sq_dist`` does."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        d = a[:, j] - b[:, j]
        out += d * d
    return out


def _keep_best(q: np.ndarray, d: np.ndarray, p: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` rows of least (distance, point) of each query."""
    order = np.lexsort((p, d, q))
    q, d, p = q[order], d[order], p[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    at = rank < k
    return q[at], d[at], p[at]


def best_in_block(queries: np.ndarray, points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, distance, point)`` row numbers of the ``k`` nearest points of every query, ties to the smaller point number."""
    width = points.shape[1]
    center = points.mean(axis=0)
    qc, pc = queries - center, points - center
    scale = max(np.abs(qc).max(), np.abs(pc).max()) or 1.0
    q32, p32 = (qc / scale).astype(np.float32), (pc / scale).astype(np.float32)
    # single-precision error of |q|^2 + |p|^2 - 2 q.p, with room to spare: this share of |q|^2 + |p|^2
    slack = 2 * (width + 16) * float(np.finfo(np.float32).eps)
    qn = np.einsum("ij,ij->i", q32, q32, dtype=np.float64) * (1 - slack)
    pn = (np.einsum("ij,ij->i", p32, p32, dtype=np.float64) * (1 - slack) - 1e-30).astype(np.float32)
    found = []
    for a in range(0, len(queries), _QUERIES):
        some = slice(a, min(a + _QUERIES, len(queries)))
        n = some.stop - a
        own, dist, point = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        limit = np.full(n, np.inf)
        for b in range(0, len(points), _POINTS):
            low = q32[some] @ p32[b:b + _POINTS].T
            low *= -2
            low += pn[b:b + _POINTS]
            if b == 0 and low.shape[1] > k:  # a first bound: the k points that look nearest
                first = np.argpartition(low, k - 1, axis=1)[:, :k]
                rows = np.repeat(np.arange(n), k)
                limit = exact_dist2(queries[some][rows], points[first.ravel()]).reshape(n, k).max(axis=1)
            near, at = np.nonzero(low <= _limits(limit, scale, qn[some])[:, None])
            for c in range(0, len(near), 1 << 18):
                r, p = near[c:c + (1 << 18)], at[c:c + (1 << 18)] + b
                d = exact_dist2(queries[some][r], points[p])
                own, dist, point = _keep_best(np.concatenate([own, r]), np.concatenate([dist, d]), np.concatenate([point, p]), k)
            full = np.flatnonzero(np.bincount(own, minlength=n) == k)
            limit[full] = dist[np.searchsorted(own, full, side="right") - 1]
        found.append((own + a, dist, point))
    return tuple(np.concatenate(x) for x in zip(*found))


def _limits(limit: np.ndarray, scale: float, qn: np.ndarray) -> np.ndarray:
    """What a tile's bound is compared with: the limit less the query's own part, rounded up."""
    t = limit / scale / scale * (1 + 1e-9) - qn
    return np.nextafter(t.astype(np.float32), np.float32(np.inf))


def _blocks(points: int, queries: int, width: int, cores: int) -> tuple[int, int]:
    """Numbers of blocks of both sides."""
    most = max(BLOCK_ROWS, BLOCK_BYTES // (8 * max(width, 1)))
    even = math.isqrt(max(1, points * queries // (PAIRS_PER_CORE * cores)))
    rows = min(most, max(BLOCK_ROWS, even))
    return max(1, -(-points // rows)), max(1, -(-queries // rows))


def candidates(points: DataFrame, spots: DataFrame, keep: int, width: int) -> DataFrame:
    """``(spot, ids, first, dist2)``: for every query ``(spot, qv)`` the ``keep`` nearest points ``(ids, tv)`` of each block.

    All vectors have ``width`` finite entries; ``first`` is the least of ``ids``.
    """
    spark = points.sparkSession
    ship_package(spark)
    n_points, n_queries = _blocks(points.count(), spots.count(), width, spark.sparkContext.defaultParallelism)
    pairs = n_points * n_queries
    own = F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(n_points))
    p = points.select("ids", "tv", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))).alias("__q"), own.alias("__p"))
    q = spots.select("spot", "qv", F.pmod(F.xxhash64("spot"), F.lit(n_queries)).alias("__q"), F.explode(F.sequence(F.lit(0), F.lit(n_points - 1))).alias("__p"))
    pair = (F.col("__q").cast("long") * n_points + F.col("__p")).alias("pair")
    p, q = p.select(pair, "ids", "tv"), q.select(pair, "spot", "qv")
    ids_type, spot_type = points.schema["ids"].dataType.simpleString(), spots.schema["spot"].dataType.simpleString()
    schema = f"spot {spot_type}, ids {ids_type}, first {points.schema['ids'].dataType.elementType.simpleString()}, dist2 double"
    at = 2 * pairs  # a pair of blocks has a partition nearly to itself, and the number is kept
    return q.repartition(at, "pair").groupBy("pair").cogroup(p.repartition(at, "pair").groupBy("pair")).applyInArrow(_searcher(keep), schema)


def _searcher(keep: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def search(queries: pa.Table, points: pa.Table) -> pa.Table:
        if not len(queries) or not len(points):
            own, dist, point = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        else:
            points = points.append_column("first", pac.list_element(points.column("ids"), 0)).sort_by("first")
            own, dist, point = best_in_block(_matrix(queries.column("qv")), _matrix(points.column("tv")), keep)
        ids = points.column("ids").take(pa.array(point))
        return pa.table({"spot": queries.column("spot").take(pa.array(own)), "ids": ids, "first": pac.list_element(ids, 0), "dist2": pa.array(dist)})
    return search


def nearest_exact(train: DataFrame, test: DataFrame, k: int, id_col: str, vec_col: str, exclude_self: bool) -> DataFrame:
    """``(q_id, nbr_id, dist2, rank)`` for the ``k`` nearest training points of each query, ties by id.

    Equal vectors are searched once, and of equal training vectors only the least
    ids that can be neighbours. Rows whose vector is null, holds a null or
    non-finite entry or has another length than the first training vector's take
    no part.
    """
    keep = k + 1 if exclude_self else k
    double = F.transform(vec_col, lambda x: x.cast("double"))
    finite = lambda v: F.forall(v, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    tr = train.select(F.col(id_col).alias("nbr_id"), double.alias("tv"))
    te = test.select(F.col(id_col).alias("q_id"), double.alias("qv"))
    head = tr.where(F.size("tv") > 0).select(F.size("tv")).first()
    width = head[0] if head else 0
    fit = lambda v: (F.size(v) == max(width, 1)) & finite(v)
    tr, te = stage(tr.where(fit("tv")), "knn-points"), stage(te.where(fit("qv")), "knn-queries")

    ranked = tr.withColumn("__r", F.row_number().over(Window.partitionBy("tv").orderBy("nbr_id"))).where(F.col("__r") <= keep)
    points = stage(ranked.groupBy("tv").agg(F.sort_array(F.collect_list("nbr_id")).alias("ids")), "knn-equal")  # keep ids at most
    spots = stage(te.groupBy("qv").agg(F.min("q_id").alias("spot")), "knn-spots")
    member = te.join(spots, "qv").select("q_id", "spot")

    best = F.row_number().over(Window.partitionBy("spot").orderBy("dist2", "first"))
    found = candidates(points, spots, keep, width).withColumn("__r", best).where(F.col("__r") <= keep)
    found = found.select("spot", "dist2", F.explode("ids").alias("nbr_id"))
    by_rank = F.row_number().over(Window.partitionBy("spot").orderBy("dist2", "nbr_id"))
    found = stage(found.withColumn("rank", by_rank).where(F.col("rank") <= keep), "knn-found")
    out = member.join(found, "spot").select("q_id", "nbr_id", "dist2", "rank")
    if exclude_self:
        again = F.row_number().over(Window.partitionBy("q_id").orderBy("rank"))
        out = out.where(F.col("q_id") != F.col("nbr_id")).withColumn("rank", again).where(F.col("rank") <= k)
    return out
