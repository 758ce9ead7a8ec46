"""Models on term counts against plain Python: naive Bayes, topics, sparse vectors."""

import collections
import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import term_models as TM

DOCS = {1: "aa bb bb cc", 2: "aa cc", 3: "dd dd aa", 4: "dd ee", 5: "bb dd ee ee", 6: "zz zz", 7: ""}
LABEL = {1: 0.0, 2: 0.0, 3: 1.0, 4: 1.0, 5: 1.0}
VOCABULARY = ["aa", "bb", "cc", "dd", "ee"]


@pytest.fixture
def counts(spark):
    rows = [(i, w, n) for i, text in DOCS.items() for w, n in collections.Counter(text.split()).items() if w in VOCABULARY]
    return spark.createDataFrame(rows, "doc_id long, term string, tf long")


@pytest.fixture
def vocab(spark):
    df = collections.Counter(w for text in DOCS.values() for w in set(text.split()))
    return spark.createDataFrame([(w, df[w]) for w in reversed(VOCABULARY)], "term string, df long")


def test_multinomial_naive_bayes(spark, counts, vocab):
    """Scores by the textbook formula, for words a class lacks, for a text without known words and an empty one."""
    labels = spark.createDataFrame(list(LABEL.items()), "doc_id long, label double")
    docs = spark.createDataFrame([(i,) for i in DOCS], "doc_id long")
    model = TM.multinomial_fit(counts, vocab, labels, "doc_id", "label", 0.5)
    got = {(r.doc_id, r.label): r.score for r in TM.multinomial_scores(counts, docs, model, "doc_id", "label").collect()}
    assert len(got) == 2 * len(DOCS)
    for c in (0.0, 1.0):
        words = [w for i, lab in LABEL.items() if lab == c for w in DOCS[i].split()]
        for i, text in DOCS.items():
            want = math.log(sum(v == c for v in LABEL.values()) / len(LABEL))
            want += sum(math.log((words.count(w) + 0.5) / (len(words) + 0.5 * 5)) for w in text.split() if w in VOCABULARY)
            assert got[i, c] == pytest.approx(want, abs=1e-12)
    best = {r.doc_id: r.prediction for r in TM.best_class(TM.multinomial_scores(counts, docs, model, "doc_id", "label"), "doc_id", "label").collect()}
    assert best[1] == 0.0 and best[4] == 1.0 and best[7] == 1.0  # the larger class where nothing is known


def test_gaussian_naive_bayes(spark):
    rows = [(1, 1.0, 5.0, "x"), (2, 2.0, 5.0, "x"), (3, 9.0, 5.0, "y"), (4, 11.0, 5.0, "y")]
    df = spark.createDataFrame(rows, "id long, a double, b double, label string")
    model = TM.gaussian_fit(df, ["a", "b"], "label")
    got = {(r.id, r.label): r.score for r in TM.gaussian_scores(df, model, ["a", "b"], "id", "label").collect()}
    eps = 1e-9 * ((1 - 5.75) ** 2 + (2 - 5.75) ** 2 + (9 - 5.75) ** 2 + (11 - 5.75) ** 2) / 4
    want = math.log(0.5) - math.log(2 * math.pi * (0.25 + eps)) / 2 - 0.25 / (2 * (0.25 + eps)) - math.log(2 * math.pi * eps) / 2
    assert got[1, "x"] == pytest.approx(want)
    assert {r.id: r.prediction for r in TM.best_class(TM.gaussian_scores(df, model, ["a", "b"], "id", "label"), "id", "label").collect()} == {1: "x", 2: "x", 3: "y", 4: "y"}


def test_topics_separate_two_vocabularies(spark):
    left, right = [f"l{i}" for i in range(6)], [f"r{i}" for i in range(6)]
    rows = [(d, w, 1 + (d + i) % 3) for d in range(40) for i, w in enumerate(left if d % 2 else right) if (d + i) % 4]
    counts = spark.createDataFrame(rows, "doc_id long, term string, tf long")
    weights = TM.lda_fit(counts, "doc_id", 2, rounds=25, seed=3)
    sums = weights.agg(F.sum("p0"), F.sum("p1")).first()
    assert sums[0] == pytest.approx(1) and sums[1] == pytest.approx(1)
    top = {}
    for r in TM.top_words(weights, 2, 5).collect():
        top.setdefault(r.topic, []).append((r["rank"], r.word))
    assert sorted(sorted({w[0] for _, w in t}) for t in top.values()) == [["l"], ["r"]] and all(len(t) == 5 for t in top.values())
    mix = TM.lda_mix(spark.createDataFrame([(1, "l1", 4), (1, "unknown", 9), (2, "r2", 1)], "doc_id long, term string, tf long"), weights, "doc_id", 2).collect()
    assert len(mix) == 2 and all(r.t0 + r.t1 == pytest.approx(1) and max(r.t0, r.t1) > 0.8 for r in mix)
    assert (mix[0].t0 > 0.5) != (mix[1].t0 > 0.5)


def test_sparse_vectors(spark, counts, vocab):
    docs = spark.createDataFrame([(i, float(len(t)), None if i == 1 else 2.0) for i, t in DOCS.items()], "doc_id long, len double, other double")
    numbered = TM.numbered_vocabulary(vocab)
    assert {r.term: r.idx for r in numbered.collect()} == {w: i for i, w in enumerate(VOCABULARY)}
    cells = TM.weighted_terms(counts, numbered, docs, "doc_id")
    got = {r.doc_id: r for r in TM.assemble_sparse(cells, docs, "doc_id", 5, ["len", "other"]).collect()}
    assert len(got) == len(DOCS) and {r.size for r in got.values()} == {7}
    assert got[1].indices == [0, 1, 2, 5] and got[1].values[1] == pytest.approx(2 * math.log(8 / 3)) and got[1].values[-1] == 11.0
    assert got[7].indices == [6] and got[6].indices == [5, 6]


def test_a_vocabulary_of_many_terms_stays_off_the_driver(spark):
    """A term per row; only sums come back."""
    big = spark.range(200_000).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("term"), F.lit(1).cast("long").alias("df"))
    numbered = TM.numbered_vocabulary(big)
    assert numbered.agg(F.count_distinct("idx"), F.max("idx")).first()[:] == (200_000, 199_999)
