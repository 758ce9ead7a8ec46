"""Nearest dictionary words without comparing all words of a first letter.

Both searches widen a band until every word has its nearest entry. In each round
an index brings together exactly those pairs that can lie within the band, so
the nearest entry found within it is the nearest of all, and only words without
one go into the next round.

* **Jaccard of character n-grams**: an inverted index over n-grams. To reach a
  similarity ``t``, two sets must share one of their rarest ``|A| - ceil(t |A|) + 1``
  grams and have sizes within a factor ``t``. A gram with more than ``HOT``
  entries is dealt into slices, so no key holds an unbounded list.
* **Levenshtein**: a segment index. An entry is cut into ``e + 1`` segments; if a
  word lies within ``e`` edits, it holds one of them unchanged at a place moved by
  ``e`` at most. ``e`` doubles from round to round, and the distance itself is
  computed within that band.

Candidates share the first letter, as the dictionary blocks of the callers do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.staging import hinted, stage
from tessera.operators.text import char_ngrams, jaccard_distance

#: Similarities reached for, as (numerator, denominator); the last round takes any shared gram.
BANDS = [(1, 2), (1, 5), None]
#: Entries of one gram in a slice of the index.
HOT = 4096


def _block(c: str | Column) -> Column:
    return F.substring(c, 1, 1)


def candidate_counts(queries: DataFrame, dictionary: DataFrame, qcol: str, dcol: str) -> DataFrame:
    """``(word, n_candidates)``: entries of the same first letter, counted by letter and not by pairs."""
    sizes = dictionary.groupBy(_block(dcol).alias("__b")).agg(F.count(F.lit(1)).alias("n_candidates"))
    return queries.withColumn("__b", _block(qcol)).join(sizes, "__b").select(qcol, "n_candidates")


def _ranked_grams(words: DataFrame, n: int, frequency: DataFrame) -> DataFrame:
    """``(w, grams)``, rarest first; words shorter than ``n`` have no row."""
    each = words.select("w", F.explode(char_ngrams(F.col("w"), n)).alias("gram")).join(frequency.select("gram", "f"), "gram", "left")
    ranked = F.sort_array(F.collect_list(F.struct(F.coalesce("f", F.lit(0)).alias("f"), "gram")))  # one word's grams
    return each.groupBy("w").agg(ranked.alias("__g")).select("w", F.col("__g.gram").alias("grams"))


def _rare(grams: str, band: tuple[int, int] | None) -> Column:
    """The grams of which one must be shared to be within the band."""
    if band is None:
        return F.col(grams)
    p, q = band
    return F.slice(grams, 1, F.expr(f"CAST(size({grams}) - ({p} * size({grams}) + {q - 1}) div {q} + 1 AS int)"))


def jaccard_pairs(words: DataFrame, index: DataFrame, frequency: DataFrame, band: tuple[int, int] | None) -> DataFrame:
    """``(w, entry, wg, eg)`` of pairs that can reach the band; a pair may come several times."""
    slices = frequency.select("gram", F.expr(f"CAST((f + {HOT - 1}) div {HOT} AS int)").alias("__n")).where("__n > 1")
    hot = hinted(stage(slices, "hot-grams"))
    post = index.select("entry", "eg", _block("entry").alias("__b"), F.explode(_rare("eg", band)).alias("gram")).join(hot, "gram", "left")
    post = post.withColumn("__s", F.coalesce(F.pmod(F.xxhash64("entry"), "__n"), F.lit(0)).cast("int")).drop("__n")
    ask = words.select("w", "wg", _block("w").alias("__b"), F.explode(_rare("wg", band)).alias("gram")).join(hot, "gram", "left")
    ask = ask.withColumn("__s", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__n"), F.lit(1)) - 1))).drop("__n")
    pairs = ask.join(post, ["__b", "gram", "__s"])
    if band is not None:
        p, q = band
        pairs = pairs.where(f"{p} * size(wg) <= {q} * size(eg) AND {p} * size(eg) <= {q} * size(wg)")
    return pairs.select("w", "entry", "wg", "eg")


def best_by_jaccard(queries: DataFrame, dictionary: DataFrame, qcol: str, dcol: str, n: int) -> DataFrame:
    """``(word, best, dist)``: the entry of least Jaccard distance of character n-gram sets (ties: smallest entry).

    A word that shares no gram with any entry of its letter, or is too short to
    have one, is at distance 1 of all of them and gets the smallest. A word of a
    letter without entries, and null words, have no row.
    """
    q = stage(queries.select(F.col(qcol).alias("w")).where("w <> ''").distinct(), "spell-words")
    d = stage(dictionary.select(F.col(dcol).alias("w")).where("w <> ''").distinct(), "spell-entries")
    frequency = stage(d.select(F.explode(char_ngrams(F.col("w"), n)).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("f")), "spell-grams")
    index = stage(_ranked_grams(d, n, frequency).select(F.col("w").alias("entry"), F.col("grams").alias("eg")), "spell-index")
    open_ = stage(_ranked_grams(q, n, frequency).select("w", F.col("grams").alias("wg")), "spell-open")
    found = []
    for band in BANDS:
        limit = 1.0 if band is None else 1.0 - band[0] / band[1]
        scored = jaccard_pairs(open_, index, frequency, band).withColumn("dist", jaccard_distance(F.col("wg"), F.col("eg")))
        best = scored.groupBy("w").agg(F.min(F.struct("dist", F.col("entry").alias("best"))).alias("m"))
        found.append(stage(best.where(F.col("m.dist") <= limit).select("w", "m.best", "m.dist"), "spell-best"))
        open_ = stage(open_.join(found[-1], "w", "left_anti"), "spell-open")
        if open_.isEmpty():
            break
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    first = d.groupBy(_block("w").alias("__b")).agg(F.min("w").alias("best"))
    rest = q.join(hits, "w", "left_anti").withColumn("__b", _block("w")).join(first, "__b").select("w", "best", F.lit(1.0).alias("dist"))
    return hits.unionByName(rest).withColumnRenamed("w", qcol)


def _segment_start(length: str, i: str, e: int) -> str:
    """SQL of the 1-based start of segment ``i`` of ``e + 1``: the last ``length % (e + 1)`` are longer by one."""
    return f"(1 + {i} * ({length} div {e + 1}) + greatest(0, {i} - ({e + 1} - {length} % {e + 1})))"


def _segment_length(length: str, i: str, e: int) -> str:
    return f"({length} div {e + 1} + CASE WHEN {i} >= {e + 1} - {length} % {e + 1} THEN 1 ELSE 0 END)"


def edit_pairs(words: DataFrame, entries: DataFrame, e: int) -> DataFrame:
    """``(w, entry)`` of all pairs of one first letter within ``e`` edits, and some others; a pair may come several times."""
    d = entries.select("entry", _block("entry").alias("__b"), F.length("entry").cast("long").alias("__l"), F.expr(f"explode(sequence(0L, {e}L))").alias("__i"))
    d = d.withColumn("__seg", F.expr(f"substr(entry, CAST({_segment_start('__l', '__i', e)} AS int), CAST({_segment_length('__l', '__i', e)} AS int))"))
    q = words.select("w", _block("w").alias("__b"), F.length("w").cast("long").alias("__k"))
    q = q.withColumn("__l", F.expr(f"explode(sequence(greatest(1L, __k - {e}), __k + {e}))")).withColumn("__i", F.expr(f"explode(sequence(0L, {e}L))"))
    q = q.withColumn("__p", F.expr(_segment_start("__l", "__i", e))).withColumn("__n", F.expr(_segment_length("__l", "__i", e)))
    q = q.withColumn("__from", F.greatest(F.lit(1), F.col("__p") - e)).withColumn("__to", F.least(F.col("__k") - F.col("__n") + 1, F.col("__p") + e))
    texts = "array_distinct(transform(sequence(__from, __to), x -> substr(w, CAST(x AS int), CAST(__n AS int))))"
    q = q.withColumn("__seg", F.expr(f"explode(CASE WHEN __n = 0 THEN array('') WHEN __from <= __to THEN {texts} END)"))
    return q.select("w", "__b", "__l", "__i", "__seg").join(d, ["__b", "__l", "__i", "__seg"]).select("w", "entry")


def best_by_edit_distance(queries: DataFrame, dictionary: DataFrame, qcol: str, dcol: str) -> DataFrame:
    """``(word, best, dist)``: the entry of least Levenshtein distance (ties: smallest entry).

    A word of a letter without entries, and null or empty words, have no row.
    """
    d = stage(dictionary.select(F.col(dcol).alias("entry")).where("entry <> ''").distinct(), "spell-entries")
    letters = d.select(_block("entry").alias("__b")).distinct()
    words = queries.select(F.col(qcol).alias("w")).where("w <> ''").distinct()
    open_ = stage(words.withColumn("__b", _block("w")).join(letters, "__b", "left_semi").drop("__b"), "spell-open")
    found, e = [], 1
    while True:
        scored = edit_pairs(open_, d, e).withColumn("dist", F.levenshtein("w", "entry", e)).where("dist >= 0")
        best = scored.groupBy("w").agg(F.min(F.struct("dist", F.col("entry").alias("best"))).alias("m"))
        found.append(stage(best.select("w", "m.best", F.col("m.dist").cast("bigint").alias("dist")), "spell-best"))
        open_ = stage(open_.join(found[-1], "w", "left_anti"), "spell-open")
        if open_.isEmpty():
            break
        e *= 2
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.withColumnRenamed("w", qcol)
