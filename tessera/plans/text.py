"""T1-T14 (and J5, W10, U2): tokens, vocabularies, tf-idf, n-grams, spelling."""

from pyspark.sql import functions as F

from tessera.functions.staging import stage
from tessera.operators import spelling as S
from tessera.operators import text as X
from tessera.plans.registry import query

# English stop words used by the vectoriser queries.
STOP_WORDS = ["a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he", "in", "is", "it",
              "its", "of", "on", "that", "the", "to", "was", "were", "will", "with"]
# Irregular verb forms (inflected, lemma).
VERB_EXCEPTIONS = [("went", "go"), ("gone", "go"), ("was", "be"), ("were", "be"), ("been", "be"), ("had", "have"),
                   ("did", "do"), ("done", "do"), ("made", "make"), ("said", "say"), ("saw", "see"),
                   ("seen", "see"), ("took", "take"), ("taken", "take"), ("gave", "give"), ("given", "give")]

TOK = "'\\p{L}[\\p{L}\\p{N}_]*|\\p{N}+|[^\\s]'"
VTOK = "'[\\p{L}\\p{N}_]{2,}'"
SQL_STOP = "(" + ", ".join(f"'{w}'" for w in STOP_WORDS) + ")"
SQL_EXC = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in VERB_EXCEPTIONS) + ") v(inflected, lemma)"


def doc_tokens(t, lower=False, pattern=X.TOKEN_PATTERN):
    return X.tokens(t.documents, "doc_id", "text", pattern, lower)


@query("text_tokens", """
SELECT doc_id, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS token
FROM (SELECT doc_id, regexp_extract_all(text, """ + TOK + """) AS l FROM documents)""")
def q_tokens(spark, t):
    return doc_tokens(t).select("doc_id", F.col("pos").cast("bigint").alias("pos"), "token")


@query("text_sentences", """
WITH s AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))) AS sentence
           FROM documents)
SELECT doc_id, count(*) AS n_sentences, sum(len(string_split(sentence, ' ')))::BIGINT AS n_pieces,
       round(avg(len(string_split(sentence, ' '))), 9) AS mean_tokens FROM s GROUP BY doc_id""")
def q_sentences(spark, t):
    s = X.sentences(t.documents, "doc_id", "text").withColumn("k", F.size(F.split("sentence", " ")))
    return s.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_sentences"), F.sum("k").cast("bigint").alias("n_pieces"),
                                   F.round(F.avg("k"), 9).alias("mean_tokens"))


@query("text_token_freq", """
SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, """ + TOK + """)) AS token FROM documents)
GROUP BY token""")
def q_token_freq(spark, t):
    return X.token_freq(doc_tokens(t))


# Tokens whose relative frequency is asked for, one of them in no text.
ASKED = ["the", "and", "der", "que", ".", "zyzzyva"]


@query("text_token_share", f"""
WITH tok AS (SELECT unnest(regexp_extract_all(text, {TOK})) AS token FROM documents)
SELECT a.token, count(t.token) AS n, round(count(t.token) / (SELECT count(*) FROM tok), 12) AS share
FROM (SELECT unnest({ASKED}) AS token) a LEFT JOIN tok t ON t.token = a.token GROUP BY a.token""")
def q_token_share(spark, t):
    return X.token_share(doc_tokens(t), ASKED).withColumn("share", F.round("share", 12))


@query("text_lexical_diversity", """
SELECT lang, count(*) AS n_tokens, count(DISTINCT token) AS n_unique, round(count(DISTINCT token) / count(*), 9) AS diversity
FROM (SELECT lang, unnest(regexp_extract_all(text, """ + TOK + """)) AS token FROM documents) GROUP BY lang""")
def q_diversity(spark, t):
    tok = X.tokens(t.documents, "lang", "text")
    return tok.groupBy("lang").agg(F.count(F.lit(1)).alias("n_tokens"), F.count_distinct("token").alias("n_unique"),
                                   F.round(F.count_distinct("token") / F.count(F.lit(1)), 9).alias("diversity"))


def _lemma_sql():
    rules = X.VERB_RULES
    parts = ["SELECT word, 0 AS i, word AS cand FROM w"]
    for i, (suf, rep) in enumerate(rules, start=1):
        parts.append(f"SELECT word, {i}, substr(word, 1, length(word) - {len(suf)}) || '{rep}' FROM w "
                     f"WHERE suffix(word, '{suf}') AND length(word) > {len(suf)}")
    return " UNION ALL ".join(parts)


@query("text_lemmatize", f"""
WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents),
c AS ({_lemma_sql()}),
b AS (SELECT c.word, arg_min(cand, (length(cand), i)) AS lemma FROM c JOIN w l ON c.cand = l.word GROUP BY c.word)
SELECT w.word, coalesce(ex.lemma, b.lemma, w.word) AS lemma
FROM w LEFT JOIN b ON w.word = b.word LEFT JOIN {SQL_EXC.replace(') v(', ') ex(')} ON w.word = ex.inflected""")
def q_lemmatize(spark, t):
    words = X.tokens(t.documents, "doc_id", "text", "[a-z]+", lower=True).select(F.col("token").alias("word"))
    exc = spark.createDataFrame(VERB_EXCEPTIONS, "inflected string, lemma string")
    return X.lemmatize(words, "word", words, "word", exc)


@query("text_tag_freq", """
WITH tok AS (SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), """ + TOK + """)) AS token FROM documents),
lex AS (SELECT token, arg_min(lang, (-cnt, lang)) AS tag FROM
          (SELECT token, lang, count(*) AS cnt FROM tok WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY 1, 2) GROUP BY token)
SELECT coalesce(tag, 'UNK') AS tag, count(*) AS n FROM tok LEFT JOIN lex USING (token)
GROUP BY 1 ORDER BY n DESC, tag LIMIT 5""")
def q_tag_freq(spark, t):
    tok = X.tokens(t.documents, ["doc_id", "lang"], "text", lower=True)
    train = tok.join(t.labels.select("doc_id"), "doc_id", "left_semi")
    cnt = train.groupBy("token", "lang").agg(F.count(F.lit(1)).alias("cnt"))
    lex = cnt.groupBy("token").agg(F.min_by("lang", F.struct((-F.col("cnt")).alias("a"), F.col("lang").alias("b")))
                                   .alias("tag"))
    tagged = tok.join(lex, "token", "left").select(F.coalesce("tag", F.lit("UNK")).alias("tag"))
    freq = tagged.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
    return freq.orderBy(F.col("n").desc(), F.col("tag")).limit(5)


def _vocab_sql(where="", top=""):
    return f"""(SELECT term, df, tf FROM (
      SELECT token AS term, count(DISTINCT doc_id) AS df, count(*) AS tf,
             (SELECT count(DISTINCT doc_id) FROM documents {where}) AS n_docs
      FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), {VTOK})) AS token FROM documents {where})
      GROUP BY token)
    WHERE df >= 2 AND df <= n_docs * 0.5 AND term NOT IN {SQL_STOP}
    {top})"""


def _vocab(dt, max_features=None):
    return X.vocabulary_from_counts(dt, "doc_id", min_df=2, max_df=0.5, stop_words=STOP_WORDS, max_features=max_features)


@query("text_vocabulary", f"SELECT * FROM {_vocab_sql(top='ORDER BY tf DESC, term LIMIT 1000')}")
def q_vocabulary(spark, t):
    return _vocab(X.doc_term_counts(doc_tokens(t, True, X.VECTOR_TOKEN), "doc_id"), max_features=1000)


_TRAIN = "WHERE doc_id IN (SELECT doc_id FROM labels)"
_COUNTS_SQL = f"""(SELECT doc_id, token AS term, count(*) AS tf FROM
    (SELECT doc_id, unnest(regexp_extract_all(lower(text), {VTOK})) AS token FROM documents)
    WHERE token IN (SELECT term FROM {_vocab_sql(_TRAIN)}) GROUP BY doc_id, token)"""


def _train_vocab_counts(t):
    docs = X.by_document(t.documents.select("doc_id", "text"), "doc_id")
    dt = X.doc_term_counts(X.tokens(docs, "doc_id", "text", X.VECTOR_TOKEN, lower=True), "doc_id")
    train_dt = dt.join(t.labels.select("doc_id"), "doc_id", "left_semi")
    vocab = _vocab(train_dt)
    return train_dt, vocab, X.counts_on_vocabulary(dt, vocab, "doc_id")


@query("text_count_matrix", f"SELECT * FROM {_COUNTS_SQL}")
def q_count_matrix(spark, t):
    return _train_vocab_counts(t)[2]


_TFIDF_SQL = f"""(WITH c AS {_COUNTS_SQL},
tr AS (SELECT * FROM c WHERE doc_id IN (SELECT doc_id FROM labels)),
idf AS (SELECT term, ln((1 + (SELECT count(DISTINCT doc_id) FROM tr)) / (1 + count(DISTINCT doc_id))) + 1 AS idf FROM tr GROUP BY term),
w AS (SELECT doc_id, term, tf * idf AS w FROM c JOIN idf USING (term))
SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS tfidf FROM w)"""


def _tfidf(t):
    train_dt, vocab, counts = _train_vocab_counts(t)
    train_counts = X.counts_on_vocabulary(train_dt, vocab, "doc_id")
    return X.tfidf(counts, X.idf_table(train_counts, "doc_id", vocab), "doc_id")


@query("text_tfidf", f"SELECT doc_id, term, round(tfidf, 9) AS tfidf FROM {_TFIDF_SQL}")
def q_tfidf(spark, t):
    return _tfidf(t).withColumn("tfidf", F.round("tfidf", 9))


@query("text_tfidf_extremes", f"""
WITH m AS (SELECT term, round(max(tfidf), 9) AS max_tfidf FROM {_TFIDF_SQL} GROUP BY term)
(SELECT term, max_tfidf, 'smallest' AS side FROM m ORDER BY max_tfidf, term LIMIT 20)
UNION ALL (SELECT term, max_tfidf, 'largest' AS side FROM m ORDER BY max_tfidf DESC, term LIMIT 20)""")
def q_tfidf_extremes(spark, t):
    from tessera.operators.relational import both_ends
    m = _tfidf(t).groupBy("term").agg(F.round(F.max("tfidf"), 9).alias("max_tfidf"))
    return both_ends(m, "max_tfidf", "term", 20)


@query("text_word_ngrams", f"""
SELECT doc_id, len(l)::BIGINT AS n_unigrams, greatest(len(l) - 1, 0)::BIGINT AS n_bigrams,
       len(list_distinct(list_transform(range(1, len(l)), lambda i: l[i] || ' ' || l[i + 1])))::BIGINT AS n_distinct_bigrams
FROM (SELECT doc_id, regexp_extract_all(lower(text), {VTOK}) AS l FROM documents)""")
def q_word_ngrams(spark, t):
    d = t.documents.select("doc_id", F.regexp_extract_all(F.lower("text"), F.lit(X.VECTOR_TOKEN), 0).alias("l"))
    bi = X.word_ngrams(F.col("l"), 2)
    return d.select("doc_id", F.size("l").cast("bigint").alias("n_unigrams"), F.size(bi).cast("bigint").alias("n_bigrams"),
                    F.size(F.array_distinct(bi)).cast("bigint").alias("n_distinct_bigrams"))


def _ngram_rows_sql(n):
    return (f"SELECT {n} AS n, doc_id, unnest(list_transform(range(1, len(l) - {n} + 2), lambda i: array_to_string(l[i:i + {n - 1}], ' '))) AS gram FROM w WHERE len(l) >= {n}")


@query("text_ngram_range", f"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), {VTOK}) AS l FROM documents),
g AS ({" UNION ALL ".join(_ngram_rows_sql(n) for n in (1, 2, 3))})
SELECT n, gram, count(*) AS tf, count(DISTINCT doc_id) AS df FROM g GROUP BY n, gram HAVING count(DISTINCT doc_id) >= 5""")
def q_ngram_range(spark, t):
    """Word n-grams of one to three words as rows, with their counts; those in five documents or more."""
    d = t.documents.select("doc_id", F.regexp_extract_all(F.lower("text"), F.lit(X.VECTOR_TOKEN), 0).alias("l"))
    return X.ngram_counts(X.ngram_rows(d, "doc_id", "l", 1, 3)).where(F.col("df") >= 5)


def _wb_sql(n):
    return (f"CASE WHEN length(' ' || w || ' ') >= {n} THEN length(' ' || w || ' ') - {n} + 1 ELSE 0 END")


@query("text_char_wb_ngrams", f"""
SELECT doc_id, count(w) AS n_words, coalesce(sum({' + '.join(_wb_sql(n) for n in range(2, 6))}), 0)::BIGINT AS n_grams,
       count(DISTINCT w) AS n_distinct_words
FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[^\\s]+')) AS w FROM documents) GROUP BY doc_id""")
def q_char_wb(spark, t):
    w = X.tokens(X.by_document(t.documents.select("doc_id", "text"), "doc_id"), "doc_id", "text", "[^\\s]+", lower=True)
    w = X.doc_term_counts(w, "doc_id", materialize=False).withColumnRenamed("token", "w")  # n-grams of a word are made once per document
    grams = sum(F.size(X.char_wb_ngrams(F.col("w"), n)) for n in range(2, 6))
    return w.groupBy("doc_id").agg(F.sum("n").alias("n_words"), F.coalesce(F.sum(F.col("n") * grams), F.lit(0)).cast("bigint")
                                   .alias("n_grams"), F.count(F.lit(1)).alias("n_distinct_words"))


_SPELL_SQL = """
WITH q AS (SELECT DISTINCT substr(w, 1, length(w) - 1) AS word FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part)),
d AS (SELECT DISTINCT w AS entry FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part
      UNION ALL SELECT unnest(regexp_extract_all(lower(text), '[a-z]{2,}')) FROM documents)),
c AS (SELECT * FROM q JOIN d ON substr(word, 1, 1) = substr(entry, 1, 1))"""


def _spell_inputs(t):
    p = t.part.select(F.explode(F.split("p_name", " ")).alias("w"))
    q = p.select(F.expr("substring(w, 1, length(w) - 1)").alias("word")).distinct()
    d = p.select(F.col("w").alias("entry")).union(
        X.tokens(t.documents, "doc_id", "text", "[a-z]{2,}", lower=True).select(F.col("token").alias("entry"))).distinct()
    return q, stage(d, "spell-dictionary")


def _ngram_sql(col, n):
    return (f"CASE WHEN length({col}) >= {n} THEN list_distinct(list_transform(range(1, length({col}) - {n} + 2), "
            f"lambda i: substr({col}, i, {n}))) ELSE [] END")


@query("join_blocked_candidates", _SPELL_SQL + " SELECT word, count(*) AS n_candidates FROM c GROUP BY word")
def q_blocked(spark, t):
    q, d = _spell_inputs(t)
    return S.candidate_counts(q, d, "word", "entry")


@query("text_ngram_jaccard", _SPELL_SQL + f""",
g AS (SELECT word, entry, n, {_ngram_sql('word', 'n')} AS a, {_ngram_sql('entry', 'n')} AS b
      FROM c, (VALUES (3), (4)) v(n)),
s AS (SELECT word, entry, n, CASE WHEN len(list_distinct(list_concat(a, b))) = 0 THEN 1.0
        ELSE 1.0 - len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END AS dist FROM g)
SELECT word, n, arg_min(entry, (dist, entry)) AS best, round(min(dist), 9) AS dist FROM s GROUP BY word, n""")
def q_jaccard(spark, t):
    q, d = _spell_inputs(t)
    out = None
    for n in (3, 4):
        r = S.best_by_jaccard(q, d, "word", "entry", n).withColumn("n", F.lit(n))
        out = r if out is None else out.unionByName(r)
    return out.withColumn("dist", F.round("dist", 9))


@query("text_edit_distance", _SPELL_SQL + """
SELECT word, arg_min(entry, (levenshtein(word, entry), entry)) AS best, min(levenshtein(word, entry))::BIGINT AS dist
FROM c GROUP BY word""")
def q_edit(spark, t):
    q, d = _spell_inputs(t)
    return S.best_by_edit_distance(q, d, "word", "entry")


@query("filter_sorted_list", """
SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM documents)
WHERE length(token) > 9 GROUP BY token HAVING count(*) > 3 ORDER BY token""")
def q_sorted_list(spark, t):
    tok = X.tokens(t.documents, "doc_id", "text", "[a-z]+", lower=True).where(F.length("token") > 9)
    return X.token_freq(tok).where(F.col("n") > 3).orderBy("token")


@query("set_array_ops", f"""
SELECT p_partkey, len(list_distinct(list_concat(a, b)))::INTEGER AS n_union, len(list_intersect(a, b))::INTEGER AS n_inter
FROM (SELECT p_partkey, {_ngram_sql("split_part(p_name, ' ', 1)", 3)} AS a, {_ngram_sql("split_part(p_name, ' ', 2)", 3)} AS b FROM part)""")
def q_array_ops(spark, t):
    p = t.part.select("p_partkey", X.char_ngrams(F.split("p_name", " ")[0], 3).alias("a"),
                      X.char_ngrams(F.split("p_name", " ")[1], 3).alias("b"))
    return p.select("p_partkey", F.size(F.array_union("a", "b")).alias("n_union"),
                    F.size(F.array_intersect("a", "b")).alias("n_inter"))
