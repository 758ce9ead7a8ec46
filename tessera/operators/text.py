"""Text mining on long-form token tables.

Documents become ``(doc_id, pos, token)`` rows with built-in regex functions;
vocabularies, frequencies, n-grams and tf-idf are aggregates and equi joins on
that table. A vocabulary is data-sized in general, so it is joined (AQE picks
broadcast when it is small at run time), never collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.staging import hashed, plan_bytes, stage
from tessera.functions.subquery import attach_row

# Own tokeniser: a word (letter then letters/digits/underscore), a number, or
# any other single non-blank character.
TOKEN_PATTERN = "\\p{L}[\\p{L}\\p{N}_]*|\\p{N}+|[^\\s]"
# Vectoriser tokens: runs of at least two word characters.
VECTOR_TOKEN = "[\\p{L}\\p{N}_]{2,}"
# Bytes of stored texts whose counts one task holds, and the most partitions that documents are dealt to by that.
DOCUMENT_BYTES, DOCUMENT_PARTS = 2 << 20, 8192
# Sentence boundary: blanks after a terminal mark.
SENTENCE_SPLIT = "(?<=[.!?])\\s+"


def tokens(df: DataFrame, id_col: str | list[str], text: str, pattern: str = TOKEN_PATTERN,
           lower: bool = False) -> DataFrame:
    t = F.lower(F.col(text)) if lower else F.col(text)
    ids = [id_col] if isinstance(id_col, str) else id_col
    # the outer form: for the other, Spark filters on the size of the array first and so runs the pattern twice
    return df.select(*ids, F.posexplode_outer(F.regexp_extract_all(t, F.lit(pattern), 0)).alias("pos", "token")).where(F.col("token").isNotNull())


def sentences(df: DataFrame, id_col: str, text: str) -> DataFrame:
    return df.select(id_col, F.posexplode(F.split(F.col(text), SENTENCE_SPLIT)).alias("sent_pos", "sentence"))


def token_freq(tok: DataFrame) -> DataFrame:
    return tok.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def token_share(tok: DataFrame, asked: list[str]) -> DataFrame:
    """``(token, n, share)`` of given tokens among all tokens; zero for one that does not occur."""
    rows = tok.sparkSession.range(1).select(F.explode(F.array(*[F.lit(a) for a in dict.fromkeys(asked)])).alias("token"))
    sums = tok.agg(F.count(F.lit(1)).alias("__all"))
    n = tok.where(F.col("token").isin(*asked)).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    out = attach_row(rows.join(n, "token", "left"), sums)
    return out.select("token", F.coalesce("n", F.lit(0)).alias("n"), F.try_divide(F.coalesce("n", F.lit(0)), F.col("__all")).alias("share"))


def ngram_rows(df: DataFrame, id_col: str, words: str, a: int, b: int) -> DataFrame:
    """``(id, n, gram, first)``: every word n-gram of ``a`` to ``b`` words, a row for each place it stands.

    ``first`` marks one of the places of each n-gram in a document (none where
    the id is null), so documents can be counted without gathering their rows
    again. Rows of one document are brought together as words, before they are n-grams.
    """
    docs = df.select(id_col, words).groupBy(id_col).agg(F.collect_list(words).alias("__l"))  # the rows of one document
    grams = lambda n: F.array_sort(F.flatten(F.transform("__l", lambda l: word_ngrams(l, n))))
    per = F.array(*[F.struct(F.lit(n).alias("n"), grams(n).alias("grams")) for n in range(a, b + 1)])
    each = docs.select(id_col, F.inline(per)).select(id_col, "n", "grams")
    new = F.transform("grams", lambda g, i: F.struct(g.alias("gram"), (F.col(id_col).isNotNull() & ((i == 0) | (g != F.get("grams", i - 1)))).alias("first")))
    return each.select(id_col, "n", F.inline(new)).select(id_col, "n", "gram", "first")


def ngram_counts(rows: DataFrame) -> DataFrame:
    """``(n, gram, tf, df)`` of ``ngram_rows``: occurrences and documents of each n-gram."""
    return rows.groupBy("n", "gram").agg(F.count(F.lit(1)).alias("tf"), F.count_if("first").alias("df"))


def by_document(df: DataFrame, id_col: str) -> DataFrame:
    """``df`` dealt by document: counts per document and term then need no shuffle of their own.

    A text takes fewer bytes than the rows of its terms, so partitions are cut by
    the size of the texts: sized as texts by Spark, they would hold counts that do
    not fit in memory.
    """
    n = -(-plan_bytes(df) // DOCUMENT_BYTES)
    return df.repartition(n, id_col) if df.sparkSession.sparkContext.defaultParallelism < n <= DOCUMENT_PARTS else df.repartition(id_col)


def doc_term_counts(tok: DataFrame, id_col: str, materialize: bool = True) -> DataFrame:
    """``(id, token, n)``: the token table reduced to one row per document and term.

    Vocabulary statistics and count matrices are all derived from it, so the
    regex pass over the raw text runs once; it is written to the shared
    folder when ``materialize``.
    """
    dt = tok.groupBy(id_col, "token").agg(F.count(F.lit(1)).alias("n"))
    return stage(dt, "term-counts") if materialize else dt


def vocabulary_from_counts(dt: DataFrame, id_col: str, min_df: int = 1, max_df: float = 1.0,
                           stop_words: list[str] | None = None, max_features: int | None = None) -> DataFrame:
    """Terms kept by document-frequency limits, stop words and a top-k by corpus count.

    Only ``max_features`` (when given) is a limit, and that is the feature:
    the k most frequent terms, ties by term.
    """
    stats = dt.groupBy("token").agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("tf"))
    docs = dt.select(id_col).distinct().agg(F.count(F.lit(1)).alias("__n"))  # one row
    v = attach_row(stats, docs).where((F.col("df") >= min_df) & (F.col("df") <= F.col("__n") * max_df))
    if stop_words:
        v = v.where(~F.col("token").isin(*stop_words))
    v = v.drop("__n")
    if max_features:
        v = v.orderBy(F.col("tf").desc(), F.col("token").asc()).limit(max_features)
    # the fitted vocabulary is read by every transform: materialise it once
    return stage(v.withColumnRenamed("token", "term"), "vocabulary")


def vocabulary(tok: DataFrame, id_col: str, min_df: int = 1, max_df: float = 1.0,
               stop_words: list[str] | None = None, max_features: int | None = None) -> DataFrame:
    return vocabulary_from_counts(doc_term_counts(tok, id_col), id_col, min_df, max_df, stop_words, max_features)


def counts_on_vocabulary(dt: DataFrame, vocab: DataFrame, id_col: str) -> DataFrame:
    """Long-form document-term counts restricted to a fitted vocabulary."""
    v = hashed(vocab.select(F.col("term").alias("token")))
    return dt.join(v, "token").select(id_col, F.col("token").alias("term"), F.col("n").alias("tf"))


def count_matrix(tok: DataFrame, vocab: DataFrame, id_col: str) -> DataFrame:
    """Long-form document-term counts on a fitted vocabulary (transform only)."""
    v = vocab.select(F.col("term").alias("token"))
    return tok.join(v, "token").groupBy(id_col, F.col("token").alias("term")).agg(F.count(F.lit(1)).alias("tf"))


def idf_table(train_counts: DataFrame, id_col: str, df_t: DataFrame | None = None) -> DataFrame:
    """Smoothed idf ``ln((1+N)/(1+df)) + 1`` learned on the training counts.

    ``df_t``: a fitted vocabulary ``(term, df)`` of the same counts, whose
    document frequencies are then not counted again.
    """
    n = train_counts.select(id_col).distinct().agg(F.count(F.lit(1)).alias("__N"))  # one row
    if df_t is None:
        df_t = train_counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))  # rows are unique per (id, term)
    df_t = df_t.select("term", F.col("df").alias("__df"))
    idf = attach_row(df_t, n).select(
        "term", (F.log((F.lit(1) + F.col("__N")) / (F.lit(1) + F.col("__df"))) + 1).alias("idf"))
    return stage(idf, "idf")  # fitted weights, one row per term


def tfidf(counts: DataFrame, idf: DataFrame, id_col: str) -> DataFrame:
    """tf * idf, L2-normalised per document (long form); a window holds the terms of one document."""
    w = counts.join(idf, "term").repartition(id_col).select(id_col, "term", (F.col("tf") * F.col("idf")).alias("__w"))
    norm = F.sqrt(F.sum(F.col("__w") * F.col("__w")).over(Window.partitionBy(id_col)))
    return w.select(id_col, "term", (F.col("__w") / norm).alias("tfidf"))


def word_ngrams(words: Column, n: int) -> Column:
    """Array of space-joined word n-grams of an array column."""
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - n + 1),
                                                   lambda i: F.array_join(F.slice(words, i, n), " "))
                  ).otherwise(F.array().cast("array<string>"))


def char_ngrams(word: Column, n: int) -> Column:
    """Distinct character n-grams of a word (no padding); empty if shorter than n."""
    return F.when(F.length(word) >= n, F.array_distinct(
        F.transform(F.sequence(F.lit(1), F.length(word) - n + 1), lambda i: F.substring(word, i, n)))
    ).otherwise(F.array().cast("array<string>"))


def char_wb_ngrams(word: Column, n: int) -> Column:
    """n-grams of `` word `` (padded by one blank); none when the padded word is
    shorter than n (the padded word itself is the only gram when equal)."""
    p = F.concat(F.lit(" "), word, F.lit(" "))
    return F.when(F.length(p) >= n, F.transform(F.sequence(F.lit(1), F.length(p) - n + 1),
                                                lambda i: F.substring(p, i, n))
                  ).otherwise(F.array().cast("array<string>"))


def jaccard_distance(a: Column, b: Column) -> Column:
    inter = F.size(F.array_intersect(a, b))
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.lit(1.0) - inter / union)


def blocked_candidates(queries: DataFrame, dictionary: DataFrame, qcol: str, dcol: str) -> DataFrame:
    """Pairs sharing the first letter: an equi join on a derived key, not a cross product."""
    q = queries.withColumn("__b", F.substring(F.col(qcol), 1, 1))
    d = dictionary.withColumn("__b", F.substring(F.col(dcol), 1, 1))
    return q.join(d, "__b").drop("__b")


# Verb suffix rules (suffix, replacement), in the order tried.
VERB_RULES = [("s", ""), ("ies", "y"), ("es", "e"), ("es", ""), ("ed", "e"), ("ed", ""), ("ing", "e"), ("ing", "")]


def lemmatize(words: DataFrame, word: str, lemmas: DataFrame, lemma: str,
              exceptions: DataFrame | None = None) -> DataFrame:
    """Exception list first; else the shortest of {word, rule outputs} found in the
    lemma list (earliest rule on ties); else the word itself."""
    w = words.select(word).distinct()
    cands = [F.struct(F.lit(0).alias("i"), F.col(word).alias("cand"))]
    for i, (suf, rep) in enumerate(VERB_RULES, start=1):
        stem = F.expr(f"substring(`{word}`, 1, length(`{word}`) - {len(suf)})")
        cands.append(F.struct(F.lit(i).alias("i"),
                              F.when(F.col(word).endswith(suf) & (F.length(word) > len(suf)),
                                     F.concat(stem, F.lit(rep))).alias("cand")))
    ex = w.select(word, F.inline(F.array(*cands))).where(F.col("cand").isNotNull())
    known = ex.join(lemmas.select(F.col(lemma).alias("cand")).distinct(), "cand")
    best = known.groupBy(word).agg(F.min_by("cand", F.struct(F.length("cand"), F.col("i"))).alias("__rule"))
    out = w.join(best, word, "left")
    if exceptions is not None:
        out = out.join(exceptions.select(F.col("inflected").alias(word), F.col("lemma").alias("__exc")), word, "left")
        return out.select(word, F.coalesce("__exc", "__rule", F.col(word)).alias("lemma"))
    return out.select(word, F.coalesce("__rule", F.col(word)).alias("lemma"))
