"""The rows that each stage of the pipeline keeps, against brute force, with repeated and null ids."""

import collections
import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tessera.llm.queries import mixing_sql, quality_sql, tokenizer_path

from .test_operators import VOCABULARY, prose

STAGES = dict(corpus_pipeline.STAGES)


def base_rows():
    r = random.Random(9)
    texts = [prose(80, 700 + i) for i in range(12)]
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(texts)]
    for i in range(12, 30):  # near copies
        w = texts[i % 5].split()
        w[r.randrange(len(w))] = r.choice(VOCABULARY)
        rows.append((i, " ".join(w), "de", "s1"))
    rows += [(1, texts[0], "en", "s0"), (3, prose(80, 801), "en", "s0"), (3, prose(80, 801), "en", "s0")]  # one id, other text; equal rows
    rows += [(None, prose(80, 802), "en", "s0")] * 3 + [(None, texts[2], "en", "s0"), (None, prose(80, 803), "en", "s0")]
    return rows + [(50, None, "en", "s0"), (51, "", "en", "s0")]


def kept(df):
    return collections.Counter((r["doc_id"], r["text"]) for r in df.collect())


def brute_groups(rows):
    sets = [frozenset(zip(*((t or "").lower().split()[k:] for k in range(5)))) for _, t, *_ in rows]
    comp = list(range(len(rows)))
    for _ in range(8):
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                if x and y and 100 * len(x & y) >= 80 * len(x | y):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    groups = collections.defaultdict(list)
    for (i, t, *_), c in zip(rows, comp):
        groups[c].append((i is None, i or 0, t, i))
    return [min(g, key=lambda x: x[:2]) for g in groups.values()], groups


def test_near_duplicates_keep_one_row_of_each_group(spark, docs):
    rows = base_rows()
    firsts, _ = brute_groups(rows)
    got = kept(STAGES["near_duplicates"](spark, docs(rows), ""))
    assert got == collections.Counter((x[3], x[2]) for x in firsts)


@pytest.mark.parametrize("name", ["quality_rules", "mix_sources"])
def test_kept_rows_equal_sql(name, spark, duck, docs):
    rows = base_rows() + [(60 + i, "few words", "en", "s2") for i in range(3)] + [(60, "word " * 60, "de", "s2")]
    table = docs(rows)
    duck.register("small_docs", table.toArrow())
    sql = {"quality_rules": quality_sql, "mix_sources": mixing_sql}[name]("small_docs")
    want = duck.sql(f"SELECT doc_id, count(*) FROM ({sql}) WHERE kept GROUP BY 1").fetchall()
    got = STAGES[name](spark, table, "").groupBy("doc_id").agg(F.count("*")).collect()
    norm = lambda found: collections.Counter({None if i is None or i != i else int(i): n for i, n in found})
    assert norm(got) == norm(want)


def test_tokens_equal_the_library(spark, docs):
    from tokenizers import Tokenizer
    ref, rows = Tokenizer.from_file(tokenizer_path()), base_rows()
    want = collections.Counter((i, len(ref.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in rows)
    assert collections.Counter((r["doc_id"], r["n_tokens"]) for r in STAGES["tokens"](spark, docs(rows), "").collect()) == want
