"""Words that stand equally often in a text and its edited text are drawn once; plans stay short."""

import collections

from pyspark.sql import functions as F

from tessera.llm import fingerprints

from .test_operators import prose


def test_equal_counts_are_laid_out_once(spark):
    pairs = {1: ("a a b c", "a a b b d"), 2: ("", "x"), 3: ("x y", ""), 4: ("", ""), 5: (prose(300, 1), prose(300, 1) + " " + prose(20, 2))}
    bags = spark.createDataFrame([(k, *v) for k, v in pairs.items()], "k bigint, a string, b string")
    rows = fingerprints.weighted_terms(bags.select("k", *[fingerprints.words(F.col(c)).alias(n) for c, n in (("a", "ws"), ("b", "edited"))]), ["k"])
    got = collections.Counter((r["k"], r["bag"]) for r in rows.collect())
    want = collections.Counter()
    for k, (a, b) in pairs.items():
        own, other = (set(collections.Counter(t.split()).items()) for t in (a, b))
        want.update({(k, fingerprints.A): len(own - other), (k, fingerprints.B): len(other - own), (k, fingerprints.BOTH): len(own & other)})
    want[(4, None)] = 1
    assert got == +want


def test_a_bag_has_one_signature_whatever_stands_beside_it(spark):
    texts = ["", "a", "a a b c", prose(80, 3), prose(80, 3) + " " + prose(9, 4), prose(200, 5)]
    bags = spark.createDataFrame([(i, j, a, b) for i, a in enumerate(texts) for j, b in enumerate(texts)], "i int, j int, a string, b string")
    got = fingerprints.signatures(bags.select("i", "j", fingerprints.words(F.col("a")).alias("ws"), fingerprints.words(F.col("b")).alias("edited")), ["i", "j"]).collect()
    of = collections.defaultdict(set)
    for r in got:
        of[r["i"]].add(tuple(r["own"] or ()))
        of[r["j"]].add(tuple(r["edited"] or ()))
    assert all(len(of[i]) == 1 for i in range(len(texts))) and len({next(iter(s)) for s in of.values()}) == len(texts)
    assert of[0] == {()} and all(len(next(iter(of[i]))) == fingerprints.SAMPLES for i in range(1, len(texts)))


def test_the_plan_does_not_spell_out_the_quantiles(docs):
    df = fingerprints.fingerprint_edits(docs([(i, prose(20, i)) for i in range(5)]))
    assert len(df._jdf.queryExecution().toString()) < 1_000_000
