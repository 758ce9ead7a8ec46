"""Merkle manifest: against a plain tree in Python, on the awkward rows and on groups around powers of the fanout."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import merkle

from .conftest import AWKWARD, DOCS

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def plain_tree(leaves):
    """Root and, per leaf, its sibling lists (left, right) from the leaf up."""
    proofs, where = [[] for _ in leaves], list(range(len(leaves)))
    while len(leaves) > 1:
        runs = [leaves[i:i + 8] for i in range(0, len(leaves), 8)]
        for k, at in enumerate(where):
            run, slot = runs[at // 8], at % 8
            proofs[k].append((run[:slot], run[slot + 1:]))
        where = [at // 8 for at in where]
        leaves = [digest(*r) for r in runs]
    return leaves[0], proofs


def plain_manifest(rows, claimed):
    """(key, leaf, subroot, root, proof, folded, verified) of rows in the order of COLUMNS."""
    groups = {}
    for r in rows:
        groups.setdefault((r[2] is not None, (r[2] or "").encode()), []).append(r)
    parts = []
    for g in sorted(groups):
        kept = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r), leaf_of(claimed(r))))
        parts.append((kept, *plain_tree([leaf_of(r) for r in kept])))
    root, upper = plain_tree([p[1] for p in parts])
    out = []
    for (kept, subroot, proofs), above in zip(parts, upper):
        for r, proof in zip(kept, proofs):
            at = leaf_of(claimed(r))
            for left, right in proof + above:
                at = digest(*left, at, *right)
            siblings = [x for left, right in proof + above for x in left + right]
            out.append((r[0], leaf_of(r), subroot, root, digest(*siblings), at, at == root))
    return sorted(out, key=repr)


def check(spark, rows):
    df = spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3]) for r in rows], DOCS)
    got = merkle.manifest(df, COLUMNS, "lang", "doc_id", {"text": merkle.lower_ascii(F.col("text"))})
    lower = lambda t: None if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    want = plain_manifest(rows, lambda r: (*r[:4], lower(r[4])))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    return want


@pytest.mark.parametrize("sizes", [[1], [8], [1, 1], [9, 64, 65], [130, 1, 7]])
def test_trees_of_many_sizes(spark, sizes):
    rows = [(1000 * g + i, "src0", None if g == 1 else f"l{g}", 5, f"Text {i}" if i % 2 else f"text {i}")
            for g, n in enumerate(sizes) for i in range(n)]
    want = check(spark, rows)
    assert {r[6] for r in want} == ({False, True} if sum(sizes) > 2 else {True})


def test_many_groups(spark):
    check(spark, [(i, "s", f"lang{i % 75}", 1, f"A{i}") for i in range(200)])


def test_awkward_rows(spark):
    rows = [(r[0], "src0", r[2] if len(r) > 2 else "en", len(r[1] or ""), r[1]) for r in AWKWARD]
    rows += [(10, None, "", None, "É" * 300_000 + "Z"), (10, None, "", None, "É" * 300_000 + "Z")]
    assert len(check(spark, rows)) == len(rows)


def test_empty_table_and_clashing_columns(spark, docs):
    none = merkle.manifest(docs([]), COLUMNS, "lang", "doc_id")
    assert none.collect() == [] and none.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    plain = docs([(1, "a"), (2, "b")])
    more = plain.withColumns({c: F.lit(3) for c in ("gid", "at", "n", "c0", "path", "child", "digest", "leaf", "root", "__at")})
    run = lambda d: sorted(map(tuple, merkle.manifest(d, COLUMNS, "lang", "doc_id").collect()))
    assert run(more) == run(plain)
