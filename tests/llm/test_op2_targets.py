"""Targets of one's own are reached, and those that cannot be are reported."""

import pytest

from tessera.llm import mixing

from .test_operators import prose


def test_given_targets_are_reached(spark, docs):
    table = docs([(i, prose(20 + i % 30, i), "en" if i % 4 else "de", "big" if i % 3 else f"s{i % 5}") for i in range(400)])
    want = spark.createDataFrame([("big", 0.2)], "value string, share double")
    got = mixing.sample(table, targets={"source": want}).toPandas()
    weight = (got["mix_p"] * got["mix_tokens"]).groupby(got["source"]).sum()
    assert weight["big"] / weight.sum() == pytest.approx(0.2, abs=1e-4)


def test_targets_that_contradict_each_other_are_reported(spark, docs):
    table = docs([(i, prose(30, i), "en" if i % 2 else "de", "a" if i % 2 else "b") for i in range(40)])
    tables = {m: spark.createDataFrame([(v, 0.9)], "value string, share double") for m, v in (("source", "a"), ("lang", "de"))}
    with pytest.warns(UserWarning, match="targets not reached"):
        mixing.plan(table, targets=tables).collect()
