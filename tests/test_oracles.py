"""Every key with an oracle agrees with DuckDB on the sf0.001 tables
(names, row count and the multiset of values, columns sorted by name)."""

import collections
import math

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

ORACLES = E.oracle_sql()
QUERIES = E.queries()


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    rows = df.collect()
    rel = duck.execute(ORACLES[key])
    drows = rel.fetchall()
    dnames = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(dnames)
    so = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    do = sorted(range(len(dnames)), key=lambda i: dnames[i])
    a = collections.Counter(tuple(_norm(r[i]) for i in so) for r in rows)
    b = collections.Counter(tuple(_norm(r[j]) for j in do) for r in drows)
    assert len(rows) == len(drows)
    assert a == b


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    out = E.entry(spark)
    assert out.count() >= 0
    assert out.columns == ["l_returnflag", "n", "avg_minutes", "avg_price_capped", "avg_group_mean"]
