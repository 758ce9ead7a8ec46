"""Dates from free text, string counts, text operators on tiny hand-checked inputs."""

from pyspark.sql import functions as F

from tessera.functions import dates as D
from tessera.operators import text as X


def _dates(spark, texts):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i int, s string")
    out = df.select("i", F.date_format(D.extract_date("s"), "yyyy-MM-dd").alias("d")).orderBy("i").collect()
    return [r.d for r in out]


def test_date_cascade_formats(spark):
    texts = ["seen 04/20/2009 for pain", "03/25/93 follow-up", "Mar 20 2009 visit", "on 24 January 2001",
             "March 20th, 2009", "since Feb 2009", "in 6/2008", "2009 onward", "9/31/2009 bad", "no date here"]
    assert _dates(spark, texts) == ["2009-04-20", "1993-03-25", "2009-03-20", "2001-01-24", "2009-03-20",
                                    "2009-02-01", "2008-06-01", "2009-01-01", None, None]


def test_month_number(spark):
    df = spark.createDataFrame([("January",), ("SEP",), ("dec.",), ("foo",)], "m string")
    assert [r.n for r in df.select(D.month_number("m").alias("n")).collect()] == [1, 9, 12, None]


def test_char_wb_ngrams_padding(spark):
    df = spark.createDataFrame([("a",), ("abc",)], "w string")
    rows = df.select("w", *[X.char_wb_ngrams(F.col("w"), n).alias(f"g{n}") for n in (2, 3, 4, 5)]).collect()
    a, abc = rows
    assert a.g2 == [" a", "a "] and a.g3 == [" a "] and a.g4 == [] and a.g5 == []
    assert abc.g5 == [" abc "] and abc.g2 == [" a", "ab", "bc", "c "]


def test_jaccard_distance(spark):
    df = spark.createDataFrame([("cormulent", "corpulent"), ("ab", "ab")], "a string, b string")
    d = df.select(X.jaccard_distance(X.char_ngrams(F.col("a"), 3), X.char_ngrams(F.col("b"), 3)).alias("d")).collect()
    # trigrams: 7 each, 4 shared ("cor", "ule", "len", "ent") -> 1 - 4/10
    assert abs(d[0].d - 0.6) < 1e-12
    assert d[1].d == 1.0  # both shorter than n: empty sets


def test_lemmatize_rules_and_exceptions(spark):
    words = spark.createDataFrame([("running",), ("run",), ("cities",), ("city",), ("went",), ("talked",),
                                   ("talk",), ("xyz",)], "word string")
    exc = spark.createDataFrame([("went", "go")], "inflected string, lemma string")
    got = {r.word: r.lemma for r in X.lemmatize(words, "word", words, "word", exc).collect()}
    assert got["cities"] == "city" and got["talked"] == "talk" and got["went"] == "go"
    assert got["xyz"] == "xyz" and got["run"] == "run"


def test_tokens_and_sentences(spark):
    df = spark.createDataFrame([(1, "Hi there. It's 42! Ok?")], "doc_id long, text string")
    toks = [r.token for r in X.tokens(df, "doc_id", "text").orderBy("pos").collect()]
    assert toks == ["Hi", "there", ".", "It", "'", "s", "42", "!", "Ok", "?"]
    sents = [r.sentence for r in X.sentences(df, "doc_id", "text").orderBy("sent_pos").collect()]
    assert sents == ["Hi there.", "It's 42!", "Ok?"]


def test_tfidf_rows_are_unit_norm(spark):
    c = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "a", 1)], "d int, term string, tf long")
    idf = X.idf_table(c, "d")
    w = X.tfidf(c, idf, "d")
    norms = w.groupBy("d").agg(F.sqrt(F.sum(F.col("tfidf") ** 2)).alias("n")).collect()
    assert all(abs(r.n - 1.0) < 1e-12 for r in norms)
