"""The empirical prior of host verdicts: noise of small hosts is not taken for a difference between hosts."""

import random

import pytest

from tessera.llm import quality

CLEAN = " ".join(f"w{i % 37}{i}" for i in range(40))
SYMBOLS = CLEAN + " " + "#" * 40


def kept(docs, rows):
    got = quality.judge(docs([(i, text, "en", host) for i, (host, text) in enumerate(rows)]))
    return {(rows[r.doc_id][0], rows[r.doc_id][1] == SYMBOLS): r.kept for r in got.collect()}


def test_hosts_of_one_document_get_the_mean(docs):
    """400 of them, 40 with symbols: a tenth fails, so no host is strict."""
    assert set(kept(docs, [(f"h{i}", SYMBOLS if i < 40 else CLEAN) for i in range(400)]).values()) == {True}


def test_small_hosts_are_shrunk_and_large_ones_judged_by_their_own_rate(docs):
    rows = [("bad", SYMBOLS if i < 90 else CLEAN) for i in range(100)] + [("good", SYMBOLS if i < 3 else CLEAN) for i in range(100)]
    rows += [(f"mid{k}", SYMBOLS if i < 2 else CLEAN) for k in range(60) for i in range(20)] * 5 + [("one", SYMBOLS)]
    got = kept(docs, rows)
    assert not got["bad", True] and got["bad", False]  # its documents that fail the rule go, the others stay
    assert got["good", True] and got["one", True] and got["mid3", True]


@pytest.mark.parametrize("rho", [0.0, 0.2, 0.7])
def test_moments_find_the_correlation(rho):
    rng = random.Random(5)
    sizes = [rng.randint(1, 60) for _ in range(6000)]
    rate = lambda: 0.3 if not rho else rng.betavariate(0.3 * (1 / rho - 1), 0.7 * (1 / rho - 1))
    failed = [sum(rng.random() < p for _ in range(n)) for n, p in ((n, rate()) for n in sizes)]
    mean, got = quality.beta_prior(len(sizes), sum(sizes), sum(n * n for n in sizes), sum(failed), sum(x * x / n for x, n in zip(failed, sizes)))
    assert abs(mean - 0.3) < 0.03 and abs(got - rho) < 0.03
    assert quality.beta_prior(0, 0.0, 0.0, 0.0, 0.0) == (0.0, 0.0)
