"""Topics by blocks of documents: plain Python's numbers, and no round writes a row per count."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tessera.functions import staging
from tessera.functions.hashing import portable_hash, portable_hash_of
from tessera.operators import term_models as TM
from tessera.operators import text as X

ROWS = [(d, f"w{(d * 7 + i * i) % 23}", 1 + (d + i) % 4) for d in range(60) for i in range(9)]
ROWS = [(d, w, n) for (d, w), n in {(d, w): n for d, w, n in ROWS}.items()]


def plain(rows, k, rounds, alpha, eta, seed):
    terms, docs = sorted({w for _, w, _ in rows}), sorted({d for d, _, _ in rows})
    deal = lambda w, i: int(hashlib.md5(f"{w}:{i}:{seed}".encode()).hexdigest()[:8], 16) / 2 ** 32 + 0.5
    p, t = {w: [deal(w, i) for i in range(k)] for w in terms}, {d: [1 / k] * k for d in docs}
    for _ in range(rounds):
        by_w, by_d = {w: [0.0] * k for w in terms}, {d: [0.0] * k for d in docs}
        for d, w, n in rows:
            j = [a * b for a, b in zip(p[w], t[d])]
            for i in range(k):
                by_w[w][i] += n * j[i] / sum(j)
                by_d[d][i] += n * j[i] / sum(j)
        whole = [sum(by_w[w][i] for w in terms) + eta * len(terms) for i in range(k)]
        p = {w: [(by_w[w][i] + eta) / whole[i] for i in range(k)] for w in terms}
        t = {d: [(x + alpha) / (sum(by_d[d]) + k * alpha) for x in by_d[d]] for d in docs}
    return p


@pytest.mark.parametrize("rows", [40, 1_000_000])
def test_rounds_are_those_of_plain_python_and_write_no_counts(spark, monkeypatch, rows):
    written = []
    stage = TM.stage
    monkeypatch.setattr(TM, "stage", lambda df, label: written.append(stage(df, label)) or written[-1])
    counts = spark.createDataFrame(ROWS, "doc_id long, term string, tf long").repartition(5)
    blocks = TM.document_blocks(counts, "doc_id", rows)
    got = {r.term: [r.p0, r.p1, r.p2] for r in TM.lda_fit(counts, "doc_id", 3, 4, 0.1, 0.01, 7, blocks=blocks).collect()}
    want = plain(ROWS, 3, 4, 0.1, 0.01, 7)
    assert got.keys() == want.keys() and all(got[w] == pytest.approx(want[w], abs=1e-12) for w in want)
    assert max(df.count() for df in written) <= 60 + 23 < len(ROWS)
    mix = TM.lda_mix(counts, spark.createDataFrame([(w, *v) for w, v in want.items()], "term string, p0 double, p1 double, p2 double"), "doc_id", 3, blocks=blocks).collect()
    assert len(mix) == 60 and all(r.t0 + r.t1 + r.t2 == pytest.approx(1) for r in mix)
    blocks[0].unpersist()


def test_a_round_sends_numbers_of_blocks_and_no_strings(spark, monkeypatch):
    written = []
    stage = TM.stage
    monkeypatch.setattr(TM, "stage", lambda df, label: written.append((label, stage(df, label))) or written[-1][1])
    counts = spark.createDataFrame(ROWS, "doc_id long, term string, tf long")
    blocks = TM.document_blocks(counts, "doc_id", 40)
    n = blocks.rows.count()
    assert 8 < n and blocks.rows.agg({"n_terms": "max"}).first()[0] <= 23 and sorted(i for r in blocks.rows.select("ids").collect() for i in r.ids) == list(range(60))
    TM.lda_fit(counts, "doc_id", 3, 2, blocks=blocks)
    rounds = [df for label, df in written if label == "lda-round"]
    assert len(rounds) == 2 and all(df.count() == n + blocks.shards and "string" not in dict(df.dtypes).values() for df in rounds)
    blocks.unpersist()


def test_words_and_documents_of_any_kind(spark):
    """Ids of strings, a document longer than a block, counts with a fraction, nulls, several shards, and words that the weights lack."""
    rows = [("long", f"w{i}", float(1 + i % 300)) for i in range(90)] + [(f"d{i}", f"w{i * j % 90}", 0.5) for i in range(1, 30) for j in (1, 2, 7)]
    rows = [(d, w, n) for (d, w), n in {(d, w): n for d, w, n in rows}.items()]
    counts = spark.createDataFrame([*rows, (None, "w1", 3.0), ("d1", None, 2.0)], "id string, term string, tf double")
    few = TM.LDA_SHARD
    try:
        TM.LDA_SHARD = 20
        blocks = TM.document_blocks(counts, "id", 50)
    finally:
        TM.LDA_SHARD = few
    assert blocks.shards > 4 and blocks.n_terms == 90
    got = {r.term: [r.p0, r.p1] for r in TM.lda_fit(counts, "id", 2, 3, 0.1, 0.01, 5, blocks=blocks).collect()}
    want = plain(rows, 2, 3, 0.1, 0.01, 5)
    assert got.keys() == want.keys() and all(got[w] == pytest.approx(want[w], abs=1e-12) for w in want)
    known = spark.createDataFrame([(w, *v) for w, v in want.items() if w != "w1"] + [("other", 0.5, 0.5)], "term string, p0 double, p1 double")
    mix = {r.id: (r.t0, r.t1) for r in TM.lda_mix(counts, known, "id", 2, blocks=blocks).collect()}
    plainly = {}
    for d in {d for d, w, _ in rows if w != "w1"}:
        t = [0.5, 0.5]
        for _ in range(5):
            s = [0.1, 0.1]
            for _, w, n in [r for r in rows if r[0] == d and r[1] != "w1"]:
                j = [a * b for a, b in zip(want[w], t)]
                s = [a + n * b / sum(j) for a, b in zip(s, j)]
            t = [a / sum(s) for a in s]
        plainly[d] = t
    assert mix.keys() == plainly.keys() and all(mix[d] == pytest.approx(plainly[d], abs=1e-12) for d in mix)
    blocks.unpersist()


def test_hash_of_plain_values_is_the_columns_hash(spark):
    words = ["word", "Straße", "a:b", "数"]
    got = spark.createDataFrame([(w,) for w in words], "term string").select("term", portable_hash("term", F.lit(3), seed=1).alias("h")).collect()
    assert all(portable_hash_of(r.term, 3, seed=1) == r.h for r in got) and len(got) == len(words)


def test_words_are_found_once_and_texts_dealt_by_their_size(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(1, "Two words, two"), (2, None), (3, "..."), (4, "x y")], "doc_id long, text string")
    tok = X.tokens(docs, "doc_id", "text", X.VECTOR_TOKEN, lower=True)
    assert sorted((r.doc_id, r.pos, r.token) for r in tok.collect()) == [(1, 0, "two"), (1, 1, "words"), (1, 2, "two")]
    assert tok._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    docs.write.parquet(str(tmp_path / "d"))
    read = spark.read.parquet(str(tmp_path / "d"))
    monkeypatch.setattr(X, "DOCUMENT_BYTES", 100)
    assert X.by_document(read, "doc_id").rdd.getNumPartitions() > 4
    assert sorted(X.by_document(read, "doc_id").collect()) == sorted(docs.collect())


def test_a_large_vocabulary_is_hashed_and_not_sorted(spark):
    dt = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "c", 4)], "doc_id long, token string, n long")
    vocab = staging.stage(spark.createDataFrame([("a",), ("c",)], "term string"), "words")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16")
        out = X.counts_on_vocabulary(dt, vocab, "doc_id")
        assert "ShuffledHashJoin" in out._jdf.queryExecution().executedPlan().toString()
        assert sorted(tuple(r) for r in out.collect()) == [(1, "a", 2), (2, "c", 4)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_naming_leaves_counts_where_they_are(spark, monkeypatch):
    """The top words are worked out once and go to the counts, also where Spark would broadcast nothing by itself."""
    from types import SimpleNamespace

    from tessera.plans import models
    docs = spark.createDataFrame([(d, "en" if d % 3 else "fr") for d in range(30)], "doc_id long, lang string")
    dt = spark.createDataFrame([(d, f"w{(d + i) % 17}", 1) for d in range(30) for i in range(6)], "doc_id long, token string, n long")
    weights = spark.createDataFrame([(f"w{i}", *[((i * 7 + j * 5) % 17 + 1) / 153 for j in range(models.TOPICS)]) for i in range(17)], "term string, " + ", ".join(f"p{j} double" for j in range(models.TOPICS)))
    monkeypatch.setattr(models, "_topics", lambda t: (dt, None, weights))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = models.q_topic_naming(spark, SimpleNamespace(documents=docs))
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {r.topic: (r["name"], r.score) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert "Window" not in plan and any("BroadcastHashJoin" in line and "LeftSemi" in line for line in plan.splitlines())
    held = {(d, f"w{(d + i) % 17}") for d in range(30) for i in range(6)}
    for j in range(models.TOPICS):
        top = sorted(range(17), key=lambda i: (-round(((i * 7 + j * 5) % 17 + 1) / 153, 9), f"w{i}"))[:10]
        scores = {lang: round(sum(sum((d, f"w{i}") in held for d in own) / len(own) for i in top) / 10, 9) for lang, own in (("en", [d for d in range(30) if d % 3]), ("fr", range(0, 30, 3)))}
        assert got[j] == max(((n, s) for n, s in scores.items()), key=lambda x: (x[1], x[0]))
