"""Registered queries of the text operators against their SQL, and the pipeline's stages."""

import pytest
from tests.conftest import SF_SMALL

import corpus_pipeline
from tessera.llm import mixing, pii
from tessera.llm.common import staged, table
from tessera.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ORACLES)
def test_equals_sql(name, spark, duck):
    got = QUERIES[name](spark, SF_SMALL)
    names = sorted(got.columns)
    want = duck.sql(ORACLES[name])
    order = [want.columns.index(n) for n in names]
    assert sorted(map(repr, (tuple(r) for r in got.select(names).collect()))) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = table(spark, SF_SMALL, "documents")
    columns, size = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = staged(stage(spark, docs, SF_SMALL), name)
        assert out.columns == columns
        assert 0 < out.count() <= size
        if name == "personal_data":
            assert out.count() == size and not pii.detect(out, ["doc_id"]).where("exists(spans, x -> x.base)").count()
        if name == "mix_sources":
            kept = {r["doc_id"] for r in mixing.sample(docs).where("mix_kept").collect()}
            assert kept == {r["doc_id"] for r in out.collect()}
        docs, size = out, out.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).where("n_tokens > 0").count() == docs.where("text <> ''").count()
