"""Counts by document: repeated ids and words, and one shuffle of term rows at most."""

from pyspark.sql import functions as F

from tessera.operators import text as X


def test_ngram_counts_with_repeated_and_null_ids(spark):
    rows = [(1, ["aa", "bb", "aa", "bb"]), (1, ["bb", "aa"]), (2, ["aa"]), (3, []), (4, None), (None, ["aa", "bb"])]
    out = X.ngram_counts(X.ngram_rows(spark.createDataFrame(rows, "id long, l array<string>"), "id", "l", 1, 2))
    got = {(r.n, r.gram): (r.tf, r.df) for r in out.collect()}
    assert got == {(1, "aa"): (5, 2), (1, "bb"): (4, 1), (2, "aa bb"): (3, 1), (2, "bb aa"): (2, 1)}


def test_ngrams_are_counted_with_one_shuffle_of_their_rows(spark):
    df = spark.createDataFrame([(1, ["aa", "bb"])], "id long, l array<string>")
    plan = X.ngram_counts(X.ngram_rows(df, "id", "l", 1, 3))._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning" in line and "gram" in line for line in plan.splitlines()) == 1


def test_terms_of_dealt_documents_are_not_shuffled_again(spark):
    df = spark.createDataFrame([(1, "aa bb aa"), (2, "bb"), (1, "aa")], "id long, text string")
    dt = X.doc_term_counts(X.tokens(X.by_document(df, "id"), "id", "text"), "id", materialize=False)
    assert dt._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert {(r.id, r.token, r.n) for r in dt.collect()} == {(1, "aa", 3), (1, "bb", 1), (2, "bb", 1)}


def test_char_ngrams_are_made_once_for_each_word_of_a_document(spark, tmp_path):
    import __spark_entry__ as E
    d = spark.createDataFrame([(1, "Ab ab  c"), (2, ""), (3, None), (4, "d" * 7)], "doc_id long, text string")
    d.write.parquet(str(tmp_path / "documents.parquet"))
    out = E.queries()["text_char_wb_ngrams"](spark, str(tmp_path))
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r.doc_id: (r.n_words, r.n_grams, r.n_distinct_words) for r in out.collect()}
    assert got == {1: (3, 3 + 2 + 1 + 3 + 2 + 1 + 2 + 1, 2), 4: (1, 8 + 7 + 6 + 5, 1)}


def test_idf_takes_the_frequencies_of_a_vocabulary(spark):
    counts = spark.createDataFrame([(1, "aa", 2), (2, "aa", 1), (2, "bb", 1)], "id long, term string, tf long")
    vocab = spark.createDataFrame([("aa", 2), ("bb", 1)], "term string, df long")
    own, given = X.idf_table(counts, "id"), X.idf_table(counts, "id", vocab)
    assert {tuple(r) for r in own.collect()} == {tuple(r) for r in given.collect()}
    w = X.tfidf(counts, given, "id")
    assert {r.id: round(r.s, 12) for r in w.groupBy("id").agg(F.sum(F.col("tfidf") ** 2).alias("s")).collect()} == {1: 1.0, 2: 1.0}
