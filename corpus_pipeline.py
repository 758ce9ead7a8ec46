"""Documents to training tokens: quality, near duplicates, personal data, mixing, tokens.

Each stage gets what the stage before it kept, written as Parquet in the shared
folder and read again; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, minhash, mixing, pii, quality
from tessera.llm.common import staged, table
from tessera.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no base rule, nor a rule on which their host is judged strictly."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group on five-word shingles at 0.8: that of least id (null last).

    Verdicts act on rows, which are numbered and written once: rows that share
    an id, or have none, are rows like any other, and equal rows fold to one.
    """
    rows = staged(docs.withColumn("__row", F.monotonically_increasing_id()), "pipeline-rows")
    group = staged(minhash.near_duplicates(rows, key="__row").select("__row", "component_id"), "pipeline-groups")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row")
    first = (group.join(rows.select("__row", "doc_id"), "__row").groupBy("component_id").agg(F.count("*").alias("n"), F.min(order).alias("first"))
             .where("n > 1").select("component_id", F.col("first.__row").alias("__first")))
    gone = group.join(first, "component_id").where("__row <> __first").select("__row")
    return rows.join(gone, "__row", "left_anti").select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the personal data found in them replaced by the names of their kinds."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents whose words have the target shares of sources, languages and topics."""
    return mixing.sample(docs).where("mix_kept").select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the packed ids of every document."""
    return bpe.encode(docs, tokenizer_path(), decoded=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("tokens", tokens),
]

#: Near duplicates and tokens cannot be said in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
