"""Rows that share a key keep no repeats, however many they are."""

from tessera.llm import suffix_dedup

from .test_operators import brute_repeats, prose


def test_more_rows_of_a_key_than_8192(spark):
    lead = prose(30, 41)[:120]
    n = 8500
    rows = spark.range(n).selectExpr("7L AS doc_id", f"concat('{lead}', ' ', sha2(cast(id AS string), 256)) AS text")
    got = [r["n_removed"] for r in suffix_dedup.remove_repeats(rows).collect()]
    assert len(got) == n and sorted(got)[0] == 0 and sum(x >= 120 for x in got) == n - 1


def test_copies_and_versions_of_a_key_equal_brute_force(docs):
    a, b = prose(60, 42), prose(60, 43)
    texts = [a, b, a, b + " " + a, a, "short", "short", a[:150] + "!" + a[150:]]
    got = suffix_dedup.remove_repeats(docs([(5, t) for t in texts] + [(6, a + b)])).collect()
    by_hash = docs(list(enumerate(texts))).selectExpr("doc_id", "xxhash64(text) AS h").collect()
    order = [texts[r["doc_id"]] for r in sorted(by_hash, key=lambda r: (r["h"], r["doc_id"]))]
    want = brute_repeats(dict(enumerate([*order, a + b])))
    assert sorted((r["n_removed"], bytes(r["kept"])) for r in got) == sorted(want.values())
