"""Taxonomy closure by path doubling: shortest depths, few rounds, cycles."""

import collections
import random

import pytest

from tessera.operators import taxonomy as X


def brute(edges):
    up, nodes = collections.defaultdict(set), set()
    for c, p in edges:
        up[c].add(p)
        nodes |= {c, p}
    out = set()
    for n in nodes:
        seen, front, d = {n: 0}, [n], 0
        while front:
            d += 1
            front = [p for x in front for p in up[x] if p not in seen and not seen.update({p: d})]
        out |= {(n, a, k) for a, k in seen.items()}
    return out


def got(spark, edges):
    return {tuple(r) for r in X.closure(spark.createDataFrame(edges, "child string, parent string")).collect()}


@pytest.mark.parametrize("seed", [0, 1])
def test_graphs_with_several_routes_and_cycles(spark, seed):
    rng = random.Random(seed)
    edges = [(f"n{rng.randint(0, 40)}", f"n{rng.randint(0, 40)}") for _ in range(60)]
    assert got(spark, edges) == brute(edges)


def test_a_chain_of_a_thousand_levels_in_ten_rounds(spark, monkeypatch):
    rounds = []
    stage = X.stage
    monkeypatch.setattr(X, "stage", lambda df, label: rounds.append(label) or stage(df, label))
    edges = [(f"n{i}", f"n{i + 1}") for i in range(1000)]
    c = X.closure(spark.createDataFrame(edges, "child string, parent string"))
    assert c.count() == 1001 * 1002 // 2 and c.agg({"depth": "max"}).first()[0] == 1000
    assert len(rounds) <= 12  # edges, ten doublings and the result


def test_no_edges(spark):
    assert got(spark, []) == set() and got(spark, [("a", "a")]) == {("a", "a", 0)}
