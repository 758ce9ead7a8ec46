"""Taxonomy closure and path similarity.

``path_similarity(a, b) = 1 / (1 + min over common ancestors c of d(a,c) + d(b,c))``.

The closure ``(node, ancestor, depth)`` is built by path doubling, in as many
rounds as the depth has binary digits. List-to-list best matches never emit all item pairs of a
record: items are reduced to classes with the same ancestors, and the classes of
both lists meet at ``min depth per (record, ancestor)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.staging import hinted, stage
from tessera.session import shuffle_partitions


def closure(edges: DataFrame) -> DataFrame:
    """``(node, ancestor, depth)`` including ``(node, node, 0)``; edges are ``(child, parent)``.

    Path doubling: once all pairs up to distance ``n`` are known, a pair of
    distance ``n + d`` is a pair of exactly ``n`` and one of ``d`` up to ``n``
    joined at the node between them. Rounds grow with the logarithm of the
    depth, and in a tree no pair is made twice. In a graph with several routes
    the shortest counts; cycles end, as no pair is new. Each round is written
    once, so the next one reads files.
    """
    e = edges.select("child", "parent").where("child <> parent").distinct()
    nodes = edges.select(F.col("child").alias("node")).union(edges.select(F.col("parent").alias("node"))).where("node IS NOT NULL").distinct()
    own = nodes.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("depth"))
    known = stage(e.where("child IS NOT NULL AND parent IS NOT NULL").select(F.col("child").alias("node"), F.col("parent").alias("ancestor"), F.lit(1).alias("depth")), "closure")
    parts, reach = [known], 1
    while True:
        far = parts[-1].where(F.col("depth") == reach)
        if far.isEmpty():
            break
        ahead = known.select(F.col("node").alias("__via"), F.col("ancestor").alias("__to"), F.col("depth").alias("__more"))
        longer = (far.join(ahead, F.col("ancestor") == F.col("__via")).where("node <> __to")
                  .groupBy("node", F.col("__to").alias("ancestor")).agg((F.min("__more") + reach).alias("depth")))
        parts.append(stage(longer.join(known.select("node", "ancestor"), ["node", "ancestor"], "left_anti"), "closure"))
        known = known.unionByName(parts[-1])
        reach *= 2
    return stage(known.unionByName(own), "closure")


def ancestor_classes(clo: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(node, class)`` and ``(class, ancestor, depth)``: nodes that nothing stands below share a class if they have the same ancestors.

    A node with others below it is a class of its own and among its ancestors;
    of the others only the proper ancestors are listed. A class is named by its
    least node.
    """
    inner = clo.where("node <> ancestor").select(F.col("ancestor").alias("node")).distinct().withColumn("__inner", F.lit(True))
    own = clo.join(inner, "node", "left").withColumn("__inner", F.coalesce("__inner", F.lit(False)))
    listed = F.when(F.col("__inner") | (F.col("node") != F.col("ancestor")), F.struct("ancestor", "depth"))
    ups = own.groupBy("node", "__inner").agg(F.sort_array(F.collect_list(listed)).alias("__up"))  # one node's ancestors
    named = ups.groupBy("__up").agg(F.min("node").alias("class"))
    classes = stage(ups.join(named, "__up").select("node", "class"), "taxonomy-classes")
    return classes, stage(named.select("class", F.inline("__up")), "taxonomy-lists")


def pair_similarity(pairs: DataFrame, clo: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """Path similarity for given pairs ``(keys..., a, b)``; unconnected pairs are dropped.

    A pair meets one class of each of its nodes; distances are computed once for
    each two classes that meet.
    """
    classes, lists = ancestor_classes(clo)
    of = lambda col, name: classes.select(F.col("node").alias(col), F.col("class").alias(name))
    met = stage(pairs.select(*keys, a, b).join(of(a, "__ca"), a).join(of(b, "__cb"), b)
                .select(*keys, F.when(F.col(a) == F.col(b), F.lit(0)).alias("__same"), "__ca", "__cb"), "taxonomy-pairs")
    la = lists.select(F.col("class").alias("__ca"), "ancestor", F.col("depth").alias("__da"))
    lb = lists.select(F.col("class").alias("__cb"), "ancestor", F.col("depth").alias("__db"))
    far = met.select("__ca", "__cb").distinct().join(la, "__ca").join(lb, ["__cb", "ancestor"])
    far = stage(far.groupBy("__ca", "__cb").agg(F.min(F.col("__da") + F.col("__db")).alias("__d")), "taxonomy-distances")
    j = met.join(hinted(far), ["__ca", "__cb"], "left").withColumn("__d", F.coalesce("__same", "__d")).where(F.col("__d").isNotNull())
    return j.groupBy(*keys).agg((F.lit(1.0) / (F.lit(1) + F.min("__d"))).alias("sim"))


def _classed(list1: DataFrame, list2: DataFrame, clo: DataFrame, rec: str, item: str) -> tuple[DataFrame, DataFrame]:
    """Items and classes of the records of two lists, both laid out by record.

    Items: ``rec``, ``__class``, ``item``, ``__in1``, ``__in2`` (the lists they stand in),
    each once. Classes: ``rec``, ``__class``, the numbers of items that stand in
    the first list alone, the second alone and both (``__n1``, ``__n2``, ``__n``),
    and ``__d1``, ``__d2``, the class's distance to the nearest one of the other
    list (null: none is connected).

    Items meet their classes and go to their records once; what follows stays
    there, with a row for each class of a record and ancestor of it. As rows
    multiply there, the partitions are numbered, which keeps small ones apart.
    """
    classes, lists = ancestor_classes(clo)
    both = (list1.select(rec, F.col(item).alias("node"), F.lit(True).alias("__in1"), F.lit(False).alias("__in2"))
            .unionByName(list2.select(rec, F.col(item).alias("node"), F.lit(False).alias("__in1"), F.lit(True).alias("__in2"))))
    laid = both.where(F.col(rec).isNotNull()).join(classes, "node").repartition(shuffle_partitions(clo.sparkSession), rec)
    items = laid.groupBy(rec, F.col("class").alias("__class"), F.col("node").alias(item)).agg(F.max("__in1").alias("__in1"), F.max("__in2").alias("__in2"))
    each = items.groupBy(rec, "__class").agg(F.count_if(~F.col("__in2")).alias("__n1"), F.count_if(~F.col("__in1")).alias("__n2"), F.count_if(F.col("__in1") & F.col("__in2")).alias("__n"))
    ups = each.join(hinted(lists.withColumnRenamed("class", "__class")), "__class")
    at = Window.partitionBy(rec, "ancestor")
    near = ups.withColumns({"__m1": F.min(F.when(F.col("__n1") + F.col("__n") > 0, F.col("depth"))).over(at),
                            "__m2": F.min(F.when(F.col("__n2") + F.col("__n") > 0, F.col("depth"))).over(at)})
    return items, near.groupBy(rec, "__class", "__n1", "__n2", "__n").agg(F.min(F.col("depth") + F.col("__m2")).alias("__d1"), F.min(F.col("depth") + F.col("__m1")).alias("__d2"))


def _similarity(depth: Column) -> Column:
    return F.lit(1.0) / (F.lit(1) + depth)


def best_match(list1: DataFrame, list2: DataFrame, clo: DataFrame, rec: str, item: str) -> DataFrame:
    """For each ``(rec, item)`` of list1: max similarity to any item of list2 of the same record."""
    items, near = _classed(list1, list2, clo, rec, item)
    j = items.where("__in1").join(near.select(rec, "__class", "__d1"), [rec, "__class"], "left")
    depth = F.when(F.col("__in2"), F.lit(0)).otherwise(F.col("__d1"))
    return j.where(depth.isNotNull()).select(rec, item, _similarity(depth).alias("best_sim"))


def _scores(list1: DataFrame, list2: DataFrame, clo: DataFrame, rec: str, item: str) -> DataFrame:
    """``rec``, ``__s12``, ``__s21``: mean over each list's items of their best similarity onto the other (null: none matched).

    The items of a class that stand in one list alone have one best similarity; an item of both lists has 1.
    """
    near = _classed(list1, list2, clo, rec, item)[1]
    mean = {}
    for out, n, d in (("__s12", F.col("__n1"), F.col("__d1")), ("__s21", F.col("__n2"), F.col("__d2"))):
        alone = F.when(d.isNotNull(), n).otherwise(F.lit(0))
        mean[out] = F.try_divide(F.sum(F.col("__n") + alone * F.coalesce(_similarity(d), F.lit(0.0))), F.sum(F.col("__n") + alone))
    return near.groupBy(rec).agg(*[m.alias(out) for out, m in mean.items()])


def list_score(list1: DataFrame, list2: DataFrame, clo: DataFrame, rec: str, item: str) -> DataFrame:
    """Mean over list1 items of their best similarity onto list2 (unmatched items ignored)."""
    return _scores(list1, list2, clo, rec, item).where("__s12 IS NOT NULL").select(rec, F.col("__s12").alias("score"))


def symmetric_score(list1: DataFrame, list2: DataFrame, clo: DataFrame, rec: str, item: str) -> DataFrame:
    both = _scores(list1, list2, clo, rec, item).where("__s12 IS NOT NULL AND __s21 IS NOT NULL")
    return both.select(rec, ((F.col("__s12") + F.col("__s21")) / 2).alias("score"))
