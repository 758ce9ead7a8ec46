"""Best matches of lists in a taxonomy against brute force, and their plan."""

import collections

import pytest

from tessera.operators import taxonomy as TX

EDGES = [("R1", "ROOT"), ("R2", "ROOT"), ("N1", "R1"), ("N2", "R1"), ("N3", "R2"), ("a", "N1"), ("b", "N1"), ("c", "N2"), ("d", "N3"), ("e", "N3"),
         ("b", "R2"), ("m", "a"), ("x", "y"), ("z", "y")]  # b has two parents, m stands below a leaf's sibling, x-y-z is an island
LISTS = {1: ("a", "aab"), 2: ("abc", "d"), 3: ("a", "x"), 4: ("ax", "zc"), 5: ("", "a"), 6: ("a?", "b?"), 7: ("m", "ab"), 8: ("ae", "ea"),
         9: (["N1", "ROOT"], "b"), 10: (["a", None], ["a", None]), None: ("a", "a"), 11: ("bde", "abcde")}


def distances():
    up = collections.defaultdict(dict)
    for n in {n for e in EDGES for n in e}:
        todo = [(n, 0)]
        while todo:
            at, d = todo.pop(0)
            if d < up[n].get(at, 99):
                up[n][at] = d
                todo += [(p, d + 1) for c, p in EDGES if c == at]
    return up


def brute(side):
    up, best = distances(), {}
    for rec, lists in LISTS.items():
        one, two = (set(lists[i]) & set(up) for i in (side, 1 - side))
        for a in one if rec is not None else ():
            sims = [1 / (1 + up[a][c] + up[b][c]) for b in two for c in set(up[a]) & set(up[b])]
            if sims:
                best[rec, a] = max(sims)
    return best


def means(best):
    by = collections.defaultdict(list)
    for (rec, _), s in best.items():
        by[rec].append(s)
    return {rec: sum(v) / len(v) for rec, v in by.items()}


@pytest.fixture(scope="module")
def tables(spark):
    lists = [spark.createDataFrame([(rec, i) for rec, two in LISTS.items() for i in two[n]], "rec int, item string") for n in (0, 1)]
    return lists, TX.closure(spark.createDataFrame(EDGES, "child string, parent string"))


def test_best_matches_and_scores_equal_brute_force(tables):
    (one, two), clo = tables
    for side, pair in ((0, (one, two)), (1, (two, one))):
        got = {(r.rec, r.item): r.best_sim for r in TX.best_match(*pair, clo, "rec", "item").collect()}
        assert got == pytest.approx(brute(side))
        assert {r.rec: r.score for r in TX.list_score(*pair, clo, "rec", "item").collect()} == pytest.approx(means(brute(side)))
    s12, s21 = means(brute(0)), means(brute(1))
    got = {r.rec: r.score for r in TX.symmetric_score(one, two, clo, "rec", "item").collect()}
    assert got == pytest.approx({rec: (s12[rec] + s21[rec]) / 2 for rec in s12.keys() & s21.keys()})


def test_rows_go_to_their_records_once(spark, tables):
    """Ancestors are met in the partition of the record: one exchange for the join with the classes, one to the records."""
    (one, two), clo = tables
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = TX.symmetric_score(one, two, clo, "rec", "item")._jdf.queryExecution().sparkPlan().toString()
        done = TX.symmetric_score(one, two, clo, "rec", "item")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("Window") and done.count("Exchange hashpartitioning") == 3
