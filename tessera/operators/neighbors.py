"""k nearest neighbours, their vote, SMOTE and ENN.

The search is exact. Vectors of many dimensions are compared block by block
(``block_neighbors``), those of few by pivot cells, as follows; on request, hash
tables search approximately (``hashed_neighbors``). Points are assigned to the
Voronoi cell of the nearest of ``P`` pivots (P sampled training points; a
parameter-sized list). Each cell's radius is the
largest pivot distance of its training points. For a query q:

1. the candidates of its home cell give the k-th distance ``U_q`` (an upper
   bound of the true k-th neighbour distance; infinite if the cell has fewer
   than k points);
2. by the triangle inequality a point x of cell c satisfies
   ``d(q, x) >= d(q, p_c) - r_c``, so only cells with ``d(q, p_c) - r_c <= U_q``
   can hold a nearer point; those cells are joined as well;
3. the k best of all candidates, ordered by (distance, id), are exact.

Every step is an equi join on the cell id (a hot cell is split by AQE's
skew-join handling) plus a window per query point; no pair outside the
candidate cells is ever formed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import WIDE_SPACE, portable_hash, wide_hash
from tessera.functions.staging import stage
from tessera.operators.block_neighbors import nearest_exact
from tessera.operators.hashed_neighbors import nearest

#: From this many dimensions on, the triangle inequality hardly rules out a cell.
BLOCK_WIDTH = 16


def as_double(vec: Column) -> Column:
    return F.transform(vec, lambda x: x.cast("double"))


def sq_dist(a: Column, b: Column) -> Column:
    """Squared Euclidean distance, summed in index order."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v)


def _pivot_dists(vec: Column, pivots: list[list[float]]) -> Column:
    return F.array(*[F.sqrt(sq_dist(vec, F.array(*[F.lit(float(x)) for x in p]))) for p in pivots])


def knn_exact(train: DataFrame, test: DataFrame, k: int, id_col: str, vec_col: str, n_pivots: int = 16,
              exclude_self: bool = False, seed: int = 0) -> DataFrame:
    """``(q_id, nbr_id, dist2, rank)`` for the k nearest training points of each query, by pivot cells."""
    tr = train.select(F.col(id_col).alias("nbr_id"), as_double(F.col(vec_col)).alias("tv"))
    te = test.select(F.col(id_col).alias("q_id"), as_double(F.col(vec_col)).alias("qv"))
    piv_rows = (tr.where("tv IS NOT NULL").withColumn("__h", portable_hash("nbr_id", seed=seed)).orderBy("__h", "nbr_id")
                .limit(n_pivots).select("tv").collect())  # P vectors: parameter-sized
    pivots = [list(r.tv) for r in piv_rows]
    if not pivots:  # no training points, no neighbours
        return te.select("q_id").limit(0).withColumns({"nbr_id": F.lit(None).cast(tr.schema["nbr_id"].dataType), "dist2": F.lit(0.0), "rank": F.lit(0)})
    tr = tr.withColumn("__pd", _pivot_dists(F.col("tv"), pivots))
    tr = tr.withColumn("cell", F.array_position(F.col("__pd"), F.array_min("__pd")) - 1)
    tr = tr.withColumn("dcell", F.element_at("__pd", (F.col("cell") + 1).cast("int"))).drop("__pd")
    # both sides are read by several joins: write them once (cells included)
    tr = tr.checkpoint(eager=True)
    radius = {r.cell: r.r for r in tr.groupBy("cell").agg(F.max("dcell").alias("r")).collect()}  # <= P rows
    rad = F.array(*[F.lit(float(radius.get(j, -math.inf))) for j in range(len(pivots))])
    te = te.withColumn("__pd", _pivot_dists(F.col("qv"), pivots))
    te = te.withColumn("home", F.array_position(F.col("__pd"), F.array_min("__pd")) - 1).checkpoint(eager=True)

    def pairs(q: DataFrame, cell_col: str) -> DataFrame:
        j = q.join(tr, q[cell_col] == tr.cell)
        if exclude_self:
            j = j.where(F.col("q_id") != F.col("nbr_id"))
        return j.select("q_id", "nbr_id", sq_dist(F.col("qv"), F.col("tv")).alias("dist2"))

    w = Window.partitionBy("q_id").orderBy("dist2", "nbr_id")
    home = pairs(te, "home")
    top_home = home.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= k)
    bound = top_home.groupBy("q_id").agg(F.count(F.lit(1)).alias("__n"), F.max("dist2").alias("__u2"))
    u = F.when(F.col("__n") >= k, F.sqrt("__u2")).otherwise(F.lit(math.inf))
    te2 = te.join(bound, "q_id", "left").withColumn("__u", F.coalesce(u, F.lit(math.inf)))
    cand = F.filter(F.sequence(F.lit(0), F.lit(len(pivots) - 1)),
                    lambda j: (j != F.col("home"))
                    & (F.element_at(F.col("__pd"), j + 1) - F.element_at(rad, j + 1) <= F.col("__u")))
    other = te2.select("q_id", "qv", F.explode(cand).alias("cell_c"))
    allc = home.unionByName(pairs(other, "cell_c"))
    return (allc.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k))


def knn(train: DataFrame, test: DataFrame, k: int, id_col: str, vec_col: str, n_pivots: int = 16,
        exclude_self: bool = False, seed: int = 0, exact: bool | None = None) -> DataFrame:
    """``(q_id, nbr_id, dist2, rank)`` for the k nearest training points of each query.

    The result is that of all pairs: vectors of at least ``BLOCK_WIDTH`` entries
    go by blocks, shorter ones by pivot cells, whose pruning works in few
    dimensions. ``exact`` chooses the pivot cells for any width, or (False) the
    approximate hash tables of ``hashed_neighbors``.
    """
    if exact is None:
        head = train.where(F.col(vec_col).isNotNull()).select(F.size(vec_col)).first()
        if head is not None and head[0] >= BLOCK_WIDTH:
            return nearest_exact(train, test, k, id_col, vec_col, exclude_self)
        exact = True
    if exact:
        return knn_exact(train, test, k, id_col, vec_col, n_pivots, exclude_self, seed)
    return nearest(train, test, k, id_col, vec_col, exclude_self, sq_dist,
                   lambda tr, te, n: knn_exact(tr, te, n, id_col, vec_col, n_pivots, seed=seed), seed=seed)


def knn_of_point(train: DataFrame, point: list[float], k: int, id_col: str, vec_col: str) -> DataFrame:
    """``(nbr_id, dist2)`` of the k training points nearest to one given vector: one scan, top k per task."""
    at = F.array(*[F.lit(float(x)) for x in point])
    return (train.select(F.col(id_col).alias("nbr_id"), sq_dist(at, as_double(F.col(vec_col))).alias("dist2"))
            .orderBy("dist2", "nbr_id").limit(k))


def knn_vote(nbrs: DataFrame, train: DataFrame, id_col: str, label: str) -> DataFrame:
    """Majority label of the neighbours; ties to the smallest label."""
    lab = train.select(F.col(id_col).alias("nbr_id"), F.col(label).alias("__l"))
    c = nbrs.join(lab, "nbr_id").groupBy("q_id", "__l").agg(F.count(F.lit(1)).alias("__c"))
    return c.groupBy("q_id").agg(F.min_by("__l", F.struct((-F.col("__c")).alias("a"), F.col("__l").alias("b")))
                                 .alias("prediction"))


def knn_classify(train: DataFrame, test: DataFrame, k: int, id_col: str, vec_col: str, label: str,
                 n_pivots: int = 16) -> DataFrame:
    nb = knn(train, test, k, id_col, vec_col, n_pivots)
    return knn_vote(nb, train, id_col, label).withColumnRenamed("q_id", id_col)


def knn_sweep(train: DataFrame, test: DataFrame, ks: list[int], id_col: str, vec_col: str, label: str,
              n_pivots: int = 16) -> DataFrame:
    """Accuracy for every k in ``ks`` from one ranked neighbour table (k_max neighbours)."""
    nb = knn(train, test, max(ks), id_col, vec_col, n_pivots)
    lab = train.select(F.col(id_col).alias("nbr_id"), F.col(label).alias("__l"))
    truth = test.select(F.col(id_col).alias("q_id"), F.col(label).alias("__t"))
    ranked = nb.join(lab, "nbr_id").select("q_id", "rank", "__l", F.explode(F.array(*[F.lit(x) for x in ks])).alias("k"))
    c = ranked.where(F.col("rank") <= F.col("k")).groupBy("q_id", "k", "__l").agg(F.count(F.lit(1)).alias("__c"))
    pred = c.groupBy("q_id", "k").agg(F.min_by("__l", F.struct((-F.col("__c")).alias("a"), F.col("__l").alias("b")))
                                      .alias("prediction"))
    return pred.join(truth, "q_id").groupBy("k").agg(
        F.avg((F.col("prediction") == F.col("__t")).cast("double")).alias("accuracy"))


def smote(minority: DataFrame, n_new: int, k: int, id_col: str, vec_col: str, seed: int = 0,
          n_pivots: int = 8) -> DataFrame:
    """``n_new`` synthetic rows x + u (nbr - x): base row, one of its k nearest
    minority neighbours and u in [0, 1) all chosen by the seeded hash.

    A base row of fewer than ``k`` neighbours draws among those it has; a single
    minority row is its own neighbour, so every row asked for is made. Without
    any minority row there is nothing to draw from and no row.
    """
    from tessera.functions.ordering import dense_index
    spark = minority.sparkSession
    nb = stage(knn(minority, minority, k, id_col, vec_col, n_pivots, exclude_self=True, seed=seed), "smote-neighbours")
    have = nb.groupBy(F.col("q_id").alias(id_col)).agg(F.count(F.lit(1)).alias("__have"))
    rows = minority.select(id_col, as_double(F.col(vec_col)).alias("__xb")).join(have, id_col, "left")
    pop = stage(dense_index(rows, [id_col], "__idx"), "smote-base")
    n_min = pop.count()
    if not n_min:
        n_new = 0
    draws = spark.range(n_new).withColumnRenamed("id", "synthetic_id").select(
        "synthetic_id", (wide_hash("synthetic_id", seed=f"{seed}:base") % F.lit(max(1, n_min))).alias("__idx"),
        wide_hash("synthetic_id", seed=f"{seed}:nbr").alias("__draw"),
        (wide_hash("synthetic_id", seed=f"{seed}:u") / F.lit(float(WIDE_SPACE))).alias("u"))
    d = draws.join(pop, "__idx").withColumnRenamed(id_col, "base_id")
    d = d.withColumn("rank", F.when(F.col("__have").isNotNull(), F.col("__draw") % F.col("__have") + 1))
    d = d.join(nb.select(F.col("q_id").alias("base_id"), "rank", "nbr_id"), ["base_id", "rank"], "left")
    d = d.withColumn("nbr_id", F.coalesce("nbr_id", "base_id"))
    other = pop.select(F.col(id_col).alias("nbr_id"), F.col("__xb").alias("__xn"))
    new = F.zip_with("__xb", "__xn", lambda a, b: a + F.col("u") * (b - a))
    return d.join(other, "nbr_id").select("synthetic_id", "base_id", "nbr_id", "u", new.alias(vec_col))


def enn_filter(df: DataFrame, id_col: str, vec_col: str, label: str, k: int = 3, n_pivots: int = 16) -> DataFrame:
    """Edited nearest neighbours: keep rows whose k nearest others all share their label."""
    nb = knn(df, df, k, id_col, vec_col, n_pivots, exclude_self=True)
    lab = df.select(F.col(id_col).alias("nbr_id"), F.col(label).alias("__nl"))
    own = df.select(F.col(id_col).alias("q_id"), F.col(label).alias("__ol"))
    agree = nb.join(lab, "nbr_id").join(own, "q_id").groupBy("q_id").agg(
        F.min((F.col("__nl") == F.col("__ol")).cast("int")).alias("__all"))
    keep = agree.where(F.col("__all") == 1).select(F.col("q_id").alias(id_col))
    return df.join(keep, id_col, "left_semi")
