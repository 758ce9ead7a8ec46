"""Fixtures for the text operators: small tables with the awkward cases."""

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture
def docs(spark):
    """Make a table of documents from (doc_id, text[, lang, source]) rows."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


#: Null key, null and empty texts, white space only, ties and repeated rows.
AWKWARD = [(None, "some text without a key at all"), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "one"), (6, "two words"),
           (7, "x" * 5000), (8, "héllo wörld 😀 " * 40), (9, None, None, None)]


@pytest.fixture
def awkward(docs):
    return docs(AWKWARD)
