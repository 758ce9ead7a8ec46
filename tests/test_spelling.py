"""Spelling indexes against all pairs of one first letter: same rows, far fewer pairs, hot grams, words of any length."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.functions.staging import stage
from tessera.operators import spelling as S
from tessera.operators.text import char_ngrams


def grams(w, n):
    return {w[i:i + n] for i in range(len(w) - n + 1)}


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(words, entries, dist):
    out = {}
    for w in set(words):
        near = sorted((dist(w, d), d) for d in set(entries) if d[0] == w[0])
        if near:
            out[w] = near[0]
    return out


def jaccard(n):
    def dist(a, b):
        x, y = grams(a, n), grams(b, n)
        return 1.0 if not x | y else 1.0 - len(x & y) / len(x | y)
    return dist


def vocabulary(seed=0, n=400, letters="abcd"):
    rng = random.Random(seed)
    word = lambda a, b: "".join(rng.choices(letters, k=rng.randint(a, b)))
    entries = [word(2, 9) for _ in range(n)] + [word(15, 60) for _ in range(20)] + ["a", "b"]
    words = []
    for w in rng.sample(entries, 60):
        chars = list(w)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(chars))
            chars[at:at + 1] = rng.choice([[], [rng.choice(letters)], [chars[at], rng.choice(letters)]])
            chars = chars or ["a"]
        words.append("".join(chars))
    return words + ["a", "bb", "zz", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "dzzzz"], entries


def frames(spark, words, entries):
    return (spark.createDataFrame([(w,) for w in words + [None, ""]], "word string"),
            spark.createDataFrame([(w,) for w in entries + entries[:5] + [None, ""]], "entry string"))


def got(df):
    return {r.word: (r.dist, r.best) for r in df.collect()}


@pytest.mark.parametrize("seed", [0, 1])
def test_edit_distance_equals_all_pairs(spark, seed):
    words, entries = vocabulary(seed)
    assert got(S.best_by_edit_distance(*frames(spark, words, entries), "word", "entry")) == brute(words, entries, edit)


@pytest.mark.parametrize("n", [2, 3])
def test_jaccard_equals_all_pairs(spark, n):
    words, entries = vocabulary(2)
    assert got(S.best_by_jaccard(*frames(spark, words, entries), "word", "entry", n)) == brute(words, entries, jaccard(n))


def test_segments_miss_no_pair(spark):
    words, entries = vocabulary(3, n=150)
    q, d = spark.createDataFrame([(w,) for w in set(words)], "w string"), spark.createDataFrame([(w,) for w in set(entries)], "entry string")
    for e in (1, 2, 4):
        found = {(r.w, r.entry) for r in S.edit_pairs(q, d, e).distinct().collect()}
        assert {(a, b) for a in set(words) for b in set(entries) if a[0] == b[0] and edit(a, b) <= e} <= found


def test_far_fewer_pairs_than_letter_by_letter(spark):
    """Misspelt part names against the words of the documents."""
    part = spark.read.parquet("/root/testdata/sf0.01/part.parquet").select(F.explode(F.split("p_name", " ")).alias("w"))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    d = stage(docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{2,}"), 0)).alias("entry")).distinct(), "test-entries")
    q = stage(part.select(F.expr("substring(w, 1, length(w) - 1)").alias("w")).distinct(), "test-words")
    letter = S.candidate_counts(q, d, "w", "entry").agg(F.sum("n_candidates")).first()[0]
    assert letter == q.alias("q").join(d, F.substring("w", 1, 1) == F.substring("entry", 1, 1)).count()
    assert S.edit_pairs(q, d, 1).count() < 0.02 * letter
    f = d.select(F.explode(char_ngrams(F.col("entry"), 3)).alias("gram")).groupBy("gram").agg(F.count("*").alias("f"))
    index = S._ranked_grams(d.withColumnRenamed("entry", "w"), 3, f).select(F.col("w").alias("entry"), F.col("grams").alias("eg"))
    ask = S._ranked_grams(q, 3, f).select("w", F.col("grams").alias("wg"))
    assert S.jaccard_pairs(ask, index, f, (1, 2)).count() < 0.02 * letter


def test_a_hot_gram_is_dealt_into_slices(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT", 16)
    entries = [f"abc{a}{b}" for a in "defghijk" for b in "lmnopqrstuv"]
    words = ["abcdl", "abc", "abcxx", "abckvv"]
    assert got(S.best_by_jaccard(*frames(spark, words, entries), "word", "entry", 3)) == brute(words, entries, jaccard(3))


def test_empty_sides(spark):
    words, entries = vocabulary(4, n=80)
    q, d = frames(spark, words, entries)
    for f in (S.best_by_edit_distance, lambda *a: S.best_by_jaccard(*a, 3)):
        assert f(q, d.limit(0), "word", "entry").count() == 0 and f(q.limit(0), d, "word", "entry").count() == 0
