"""Exact quantiles (linear interpolation, as ``numpy.percentile``) at scale.

Spark's exact ``percentile`` aggregate keeps one counter per distinct value of
a group in a single buffer, which a wide-domain column or a hot group makes
unbounded. Here order statistics are selected by refining buckets:

* a round cuts the interval that holds a wanted rank into ``BUCKETS`` parts and
  counts the rows of each, a narrow partial aggregate of at most that many rows
  per interval; the part with the rank, from its smallest to its largest value,
  is the next interval;
* an interval of one value is done. One of at most ``FEW`` rows is sorted. The
  rows themselves are never sorted, sampled or shuffled: a round reads the
  staged values and joins the few intervals by broadcast;
* what is not settled after ``ROUNDS`` rounds (values over hundreds of orders of
  magnitude), or groups too many to broadcast their intervals, is ranked by a
  running count over ``(group, value)`` with range-partitioned prefix sums.

``approx=True`` switches to ``percentile_approx`` (bounded memory sketch).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.ordering import keyed_prefix_sums
from tessera.functions.staging import stage

BUCKETS, FEW, ROUNDS = 1024, 2048, 12
#: Groups whose intervals may be broadcast, together with the ranks asked for.
GROUPS = 10_000
_LARGEST = 1.7976931348623157e308


def _finite(c: Column) -> Column:
    """Half of a number, infinities as the largest ones: differences cannot overflow."""
    return F.least(F.greatest(c, F.lit(-_LARGEST)), F.lit(_LARGEST)) / 2



def select_ranks(values: DataFrame, wanted: DataFrame, by: list[str], value: str, rounds: int = ROUNDS) -> DataFrame:
    """``(by, rank, x)``: the value at each wanted rank (from 0) of its group.

    ``values`` (staged) has no null and no NaN; ``wanted`` is ``(by, rank, a, b,
    below)``: ranks with an interval that holds them and the count of values
    before it.
    """
    done, open_ = [], wanted
    for _ in range(rounds):
        open_ = stage(open_, "quantile-open")
        if open_.isEmpty():
            break
        spans = F.broadcast(open_.select(*by, "a", "b").distinct())
        inside = values.join(spans, by).where(F.col(value).between(F.col("a"), F.col("b")))
        part = (_finite(F.col(value)) - _finite(F.col("a"))) / (_finite(F.col("b")) - _finite(F.col("a")))
        part = F.when(_finite(F.col("b")) > _finite(F.col("a")), F.least(F.floor(part * BUCKETS), F.lit(BUCKETS - 1))).otherwise(0)
        parts = inside.groupBy(*by, "a", part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("na"), F.max(value).alias("nb"))
        before = F.coalesce(F.sum("n").over(Window.partitionBy(*by, "a").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        parts = parts.withColumn("__before", before)  # at most BUCKETS rows in a window
        held = open_.join(parts, [*by, "a"]).withColumn("below", F.col("below") + F.col("__before"))
        held = stage(held.where((F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("n"))), "quantile-parts")
        done.append(held.where("na = nb").select(*by, "rank", F.col("na").alias("x")))
        rest = held.where("na < nb").select(*by, "rank", F.col("na").alias("a"), F.col("nb").alias("b"), "below", "n")
        small = rest.where(F.col("n") <= FEW)
        if not small.isEmpty():
            spans = F.broadcast(small.select(*by, "a", "b").distinct())
            row = F.row_number().over(Window.partitionBy(*by, "a").orderBy(value)) - 1
            sorted_ = values.join(spans, by).where(F.col(value).between(F.col("a"), F.col("b"))).select(*by, "a", F.col(value).alias("x"), row.alias("__at"))
            done.append(stage(small.join(sorted_, [*by, "a"]).where(F.col("rank") == F.col("below") + F.col("__at")).select(*by, "rank", "x"), "quantile-small"))
        open_ = rest.where(F.col("n") > FEW).drop("n")
    else:
        open_ = stage(open_, "quantile-open")
        if not open_.isEmpty():
            done.append(_ranked(values.join(F.broadcast(open_.select(*by).distinct()), by, "left_semi"), open_, by, value))
    out = done[0] if done else wanted.select(*by, "rank", F.col("a").alias("x")).limit(0)
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _ranked(values: DataFrame, wanted: DataFrame, by: list[str], value: str) -> DataFrame:
    """The same by running counts of the distinct values."""
    counts = stage(values.groupBy(*by, value).agg(F.count(F.lit(1)).alias("__n")), "quantile-counts")
    run = keyed_prefix_sums(counts, by, [value], {"__to": "__n"})
    got = run.join(wanted.select(*by, "rank"), by).where((F.col("rank") < F.col("__to")) & (F.col("rank") >= F.col("__to") - F.col("__n")))
    return got.select(*by, "rank", F.col(value).alias("x"))


def quantiles(df: DataFrame, value: str, probs: list[float], by: list[str] | tuple = (),
              names: list[str] | None = None, approx: bool = False,
              accuracy: int = 10000) -> DataFrame:
    """One row per group: ``by`` columns + one DOUBLE column per probability.

    Null values and rows with a null in ``by`` do not count; NaN is larger than
    any number. Without rows there is a row of nulls for a table without ``by``,
    none for one with.
    """
    by = list(by)
    names = names or [f"q{int(round(p * 1000)):03d}" for p in probs]
    base = df.select(*by, F.col(value).cast("double").alias(value)).where(F.col(value).isNotNull())
    for b in by:
        base = base.where(F.col(b).isNotNull())
    if approx:
        pa = F.percentile_approx(value, list(probs), accuracy)
        out = base.groupBy(*by).agg(pa.alias("__qs"))
        return out.select(*by, *[F.col("__qs")[i].alias(n) for i, n in enumerate(names)])
    base = stage(base.withColumnRenamed(value, "__x").withColumn("__all", F.lit(0)), "quantile-values")
    keys = by or ["__all"]
    number = ~F.isnan("__x")
    groups = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"), F.count_if(number).alias("__n"), F.min(F.when(number, F.col("__x"))).alias("a"),
                                     F.max(F.when(number, F.col("__x"))).alias("b"))
    groups = stage(groups, "quantile-groups")
    ranks = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("__rows") - 1)
        ranks += [F.struct(F.lit(i).alias("i"), F.floor(pos).alias("lo"), F.ceil(pos).alias("hi"), (pos - F.floor(pos)).alias("f"))]
    asked = stage(groups.select(*keys, "__n", "a", "b", F.inline(F.array(*ranks))), "quantile-asked")
    wanted = asked.select(*keys, "__n", "a", "b", F.explode(F.array("lo", "hi")).alias("rank")).where(F.col("rank") < F.col("__n")).distinct()
    wanted = wanted.select(*keys, F.col("rank").cast("bigint").alias("rank"), "a", "b", F.lit(0).cast("bigint").alias("below"))
    values = base.where(number)
    if groups.count() * len(probs) <= GROUPS:
        at = stage(select_ranks(values, wanted, keys, "__x"), "quantile-found")
    else:
        at = stage(_ranked(values, wanted, keys, "__x"), "quantile-found")
    lo, hi = at.select(*keys, F.col("rank").alias("lo"), F.col("x").alias("__lo")), at.select(*keys, F.col("rank").alias("hi"), F.col("x").alias("__hi"))
    nan = F.lit(float("nan"))
    got = asked.join(lo, [*keys, "lo"], "left").join(hi, [*keys, "hi"], "left")
    got = got.withColumns({"__lo": F.coalesce("__lo", nan), "__hi": F.coalesce("__hi", nan)})
    step = F.when(F.col("f") == 0, F.col("__lo")).otherwise(F.col("__lo") + (F.col("__hi") - F.col("__lo")) * F.col("f"))
    return got.withColumn("__q", step).groupBy(*by).agg(*[F.max(F.when(F.col("i") == i, F.col("__q"))).alias(n) for i, n in enumerate(names)])


def quantile_row(df: DataFrame, value: str, probs: list[float], names: list[str] | None = None,
                 approx: bool = False) -> DataFrame:
    """Single-row variant (no grouping): safe to broadcast, one row by construction."""
    return quantiles(df, value, probs, (), names, approx)
