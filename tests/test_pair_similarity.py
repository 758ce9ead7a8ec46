"""Path similarity of pairs against the closure itself, and no row per ancestor of a pair."""

import random

import pytest

from tessera.operators import taxonomy as TX


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_pairs_in_trees_and_graphs(spark, monkeypatch, seed):
    rng = random.Random(seed)
    edges = [(f"n{i}", f"n{rng.randint(0, i - 1) // 3}") for i in range(1, 60)] + [("x1", "x0"), ("x2", "x0")]
    edges += [(f"n{rng.randint(0, 59)}", f"n{rng.randint(0, 59)}") for _ in range(8 * seed)]
    clo = TX.closure(spark.createDataFrame(edges, "child string, parent string"))
    up = {}
    for n, c, d in clo.collect():
        up.setdefault(n, {})[c] = d
    names = [*up, "unknown"]
    rows = [(i, rng.choice(names), rng.choice(names)) for i in range(600)] + [(600, "n5", "n5"), (600, "n5", "x1"), (601, "x1", "x1")]
    want = {}
    for i, a, b in rows:
        both = [d + up[b][c] for c, d in up.get(a, {}).items() if c in up.get(b, {})]
        if both:
            want[i] = max(want.get(i, 0.0), 1 / (1 + min(both)))
    written = {}
    stage = TX.stage
    monkeypatch.setattr(TX, "stage", lambda df, label: written.setdefault(label, stage(df, label)))
    pairs = spark.createDataFrame(rows, "k long, a string, b string")
    got = {r.k: r.sim for r in TX.pair_similarity(pairs, clo, ["k"], "a", "b").collect()}
    assert got == pytest.approx(want)
    assert written["taxonomy-pairs"].count() <= len(rows)


def test_leaves_of_one_parent_share_a_class(spark):
    clo = TX.closure(spark.createDataFrame([(f"l{i}", "p") for i in range(50)] + [("p", "r")], "child string, parent string"))
    classes, lists = TX.ancestor_classes(clo)
    assert classes.count() == 52 and classes.select("class").distinct().count() == 3 and lists.count() == 2 + 2 + 1
