"""Weighted document fingerprints by consistent weighted sampling (DataFrame functions only).

A text is a bag of words with their counts as weights. For each of 64 samples a
word ``w`` of weight ``S`` draws, from hashes of the word, two Gamma(2, 1)
numbers ``r`` and ``c`` and a uniform ``b``, rounds its weight on a random grid::

    t = floor(ln S / r + b)        ln a = ln c - r * (t - b + 1)

and the word with the least ``a`` is the sample, together with its grid step
``t``. Two texts have the same sample with a probability equal to their
generalised Jaccard similarity, ``sum min(S, T) / sum max(S, T)``.

The draws come from tables of 4096 quantiles, so a draw costs two hashes and two
look-ups. The least draws are kept by ordinary aggregation.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import barrier, staged, words

SAMPLES = 64
LEVELS = 4096
#: Samples are drawn in this many parts, which keeps the generated code of each small.
PARTS = 8
#: Where a word stands with its count: in the first bag, in the second, in both.
A, B, BOTH = 0, 1, 2
#: Documents are laid out in this many ranges of keys for each shuffle partition.
RANGES_PER_PARTITION = 2


def _gamma2_quantile(p: float) -> float:
    """Quantile of Gamma(2, 1): the x with ``1 - exp(-x) * (1 + x) = p``, by bisection."""
    lo, hi = 0.0, 60.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if 1 - math.exp(-mid) * (1 + mid) < p else (lo, mid)
    return (lo + hi) / 2


GAMMA = [_gamma2_quantile((i + 0.5) / LEVELS) for i in range(LEVELS)]


def _tables(spark: SparkSession) -> Column:
    """Quantiles of ``r``, then those of ``ln c``, as one array: a scalar subquery on a staged row.

    Plans name the file and tasks get the array as plain numbers. A literal
    array would be spelled out in every draw of every plan that the driver
    keeps as text, and be boxed number by number.
    """
    values = F.split(F.lit(",".join(map(repr, GAMMA + [math.log(g) for g in GAMMA]))), ",").cast("array<double>")
    return staged(spark.range(1, numPartitions=1).select(values.alias("quantiles")), "op10-quantiles").scalar()


def _sample(k: Column, tables: Column) -> Column:
    """Draw ``k`` of a word: order of ``ln a`` in the high half, identity of (word, t) in the low half."""
    h = F.xxhash64("term", k)
    rate = F.get(tables, h.bitwiseAND(LEVELS - 1).cast("int"))
    beta = F.shiftrightunsigned(h, 40) * F.lit(1 / (1 << 24))
    t = F.floor(F.col("log_weight") / rate + beta)
    log_a = F.get(tables, F.shiftrightunsigned(h, 12).bitwiseAND(LEVELS - 1).cast("int") + LEVELS) - rate * (t - beta + 1)
    rank = F.greatest(F.lit(0.0), F.least(F.lit(2.0**31 - 1), (log_a + 512) * (1 << 21))).cast("bigint")
    return F.shiftleft(rank, 32).bitwiseOR(F.xxhash64("term", t).bitwiseAND(F.lit(0xFFFFFFFF)))


def weighted_terms(bags: DataFrame, keys: list[str], a: str = "ws", b: str = "edited") -> DataFrame:
    """``keys``, ``term`` (hash of a word), ``log_weight`` and ``bag``, one row per distinct word and count of two arrays of words.

    ``bag`` is ``A`` or ``B``, or ``BOTH`` for a word that stands equally often
    in each. Bags are counted where they stand: the hashes of both are sorted
    together, once as they are and once with the bag in the lowest bit, which
    leaves their order, and runs of the latter are measured. No words give one
    row of nulls.
    """
    h, sides, starts, runs = (F.col(f"__f_{c}") for c in ("hashes", "sides", "starts", "runs"))
    own, other = F.col("__f_a"), F.col("__f_b")
    out = barrier(bags.select(*keys, a, b), __f_a=F.transform(a, lambda w: F.xxhash64(w)), __f_b=F.transform(b, lambda w: F.xxhash64(w))).drop(a, b)
    marked = F.concat(F.transform(own, lambda x: x.bitwiseAND(F.lit(-2))), F.transform(other, lambda x: x.bitwiseOR(F.lit(1))))
    out = barrier(out, __f_hashes=F.sort_array(F.concat(own, other)), __f_sides=F.sort_array(marked)).drop("__f_a", "__f_b")
    first = F.filter(F.transform(sides, lambda x, i: F.when(F.coalesce(F.get(sides, i - 1) != x, F.lit(True)), i)), lambda i: i.isNotNull())
    out = barrier(out, __f_starts=first)
    end = lambda j: F.coalesce(F.get(starts, j + 1), F.size(h))
    measured = F.transform(starts, lambda i, j: F.struct(F.get(h, i).alias("term"), (end(j) - i).alias("n"), F.get(sides, i).bitwiseAND(F.lit(1)).cast("int").alias("bag")))
    out = barrier(out, __f_runs=measured).select(*keys, "__f_runs")
    equal = lambda r, q: F.coalesce((q["term"] == r["term"]) & (q["n"] == r["n"]), F.lit(False))
    named = F.transform(runs, lambda r, j: F.struct(r["term"].alias("term"), F.log(r["n"].cast("double")).alias("log_weight"), F.when(
        r["bag"] == A, F.when(equal(r, F.get(runs, j + 1)), BOTH).otherwise(A)).when(~equal(r, F.get(runs, j - 1)), B).alias("bag")))
    return out.select(*keys, F.inline_outer(F.filter(named, lambda r: r["bag"].isNotNull())))


def signatures(bags: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and the signatures ``own`` and ``edited`` (arrays of ``SAMPLES`` numbers; null without words) of rows ``keys``, ``ws``, ``edited`` (words).

    Each distinct word is laid out once for each part of the samples, and each
    sample is the least draw. What stands equally often in both bags is drawn
    once: the least draw of a bag is that of its own words or of the shared ones.
    """
    ready = weighted_terms(bags, keys).select("*", F.explode(F.array(*[F.lit(p) for p in range(PARTS)])).alias("part"))
    tables, each = _tables(bags.sparkSession), SAMPLES // PARTS
    least = ready.groupBy(*keys, "bag", "part").agg(*[F.min(_sample(F.col("part") * each + i, tables)).alias(f"s{i}") for i in range(each)])
    of = {"own": B, "edited": A}
    part = least.groupBy(*keys, "part").agg(*[F.min(F.when(F.col("bag") != no, F.col(f"s{i}"))).alias(f"{c}{i}") for c, no in of.items() for i in range(each)])
    low = {c: F.array(*[F.col(f"{c}{i}").bitwiseAND(F.lit(0xFFFFFFFF)) for i in range(each)]) for c in of}
    part = part.select(*keys, "part", *[F.when(F.col(f"{c}0").isNotNull(), low[c]).alias(c) for c in of])
    whole = part.groupBy(*keys).agg(*[F.max(F.when(F.col("part") == p, F.col(c))).alias(f"{c}{p}") for c in of for p in range(PARTS)])
    return whole.select(*keys, *[F.concat(*[F.col(f"{c}{p}") for p in range(PARTS)]).alias(c) for c in of])


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples; two texts without words are alike, one without and one with are not."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return F.when(a.isNull() & b.isNull(), F.lit(1.0)).when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(same / F.lit(float(SAMPLES)))


def as_text(signature: Column) -> Column:
    """Fingerprint string: 8 hexadecimal digits for each sample (without words: empty)."""
    return F.coalesce(F.array_join(F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), ""), F.lit(""))


def in_ranges(docs: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Lay rows out in ranges of keys: ``range``, ``ghost`` and ``at`` (row number in the range).

    Null keys come last. Keys are cut at quantiles, which are keys themselves. A
    row that begins a range is also laid, as a ghost, behind the range before it
    (the first range follows the last), so every row has its successor in its
    own range: the row after it.
    """
    spark = docs.sparkSession
    n = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    least, found = docs.agg(F.min(key), F.percentile_approx(key, [i / n for i in range(n)], 100 * n)).first()
    k = F.col(key)
    if least is None:  # no keys but nulls: one order of texts
        copies = F.array(*[F.struct(F.lit(0).alias("range"), F.lit(g).alias("ghost")) for g in (False, True)])
    else:
        cuts = sorted({least, *found})  # n + 1 numbers at most
        at = F.array(*[F.lit(c) for c in cuts])
        own = F.when(k.isNull(), len(cuts) - 1).otherwise(F.size(F.filter(at, lambda c: c <= k)) - 1)
        before = F.when(F.array_contains(at, k), F.array(F.pmod(own - 1, F.lit(len(cuts))))).otherwise(F.array().cast("array<int>"))
        copies = F.concat(F.array(F.struct(own.alias("range"), F.lit(False).alias("ghost"))),
                          F.transform(F.coalesce(before, F.array().cast("array<int>")), lambda g: F.struct(g.alias("range"), F.lit(True).alias("ghost"))))
    laid = docs.select("*", F.inline(copies))
    return laid.withColumn("at", F.row_number().over(Window.partitionBy("range").orderBy("ghost", k.asc_nulls_last(), *order)))


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and what they are like.

    The edited text has the last quarter (rounded down, in code points) replaced
    by as many of the first code points of the next document by ascending key
    (or all it has); after the last document comes the first. Columns: ``key``,
    ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``.

    A null text is empty. Null keys come last; repeated keys are ordered by
    their texts; a repeated row is a further document. Equal texts have equal
    fingerprints. A single document is its own next one. Other columns are dropped.
    An empty table gives no rows; a very long text has all its words sampled.

    Texts are shuffled once, into ranges of keys; words are counted, sampled and
    compared inside the ranges without another shuffle.
    """
    base = docs.select(docs[key].cast("bigint").alias("k"), F.coalesce(docs[text], F.lit("")).alias("t"))
    follow = Window.partitionBy("range").orderBy("at")
    laid = in_ranges(base, "k", ["t"]).withColumn("next", F.coalesce(F.lead("t").over(follow), F.lit("")))
    n = F.length("t")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("t"), F.lit(1), n - cut), F.substring(F.col("next"), F.lit(1), cut))
    both = laid.select("range", "at", "ghost", "k", n.cast("bigint").alias("n_chars"), "t", edited.alias("e"))
    pairs = signatures(both.select("range", "at", words(F.col("t")).alias("ws"), words(F.col("e")).alias("edited")), ["range", "at"])
    facts = both.select("range", "at", "ghost", "k", "n_chars", F.sha2(F.col("e").cast("binary"), 256).alias("sha"))
    done = facts.join(pairs, ["range", "at"]).withColumn("after", F.lead("own").over(follow)).where("NOT ghost")
    return done.select(F.col("k").cast(docs.schema[key].dataType).alias(key), "n_chars", F.col("sha").alias("edited_sha256"),
                       as_text(F.col("own")).alias("fingerprint"), as_text(F.col("edited")).alias("edited_fingerprint"),
                       likeness(F.col("own"), F.col("edited")).alias("near_edited"), likeness(F.col("own"), F.col("after")).alias("near_next"))
