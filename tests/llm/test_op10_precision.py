"""Fingerprints have enough samples for the likeness of two texts to be read from them."""

import collections
import math

from tessera.llm import fingerprints

from .test_operators import prose


def test_likeness_is_precise(docs):
    texts = {i: prose(150, 300 + i) for i in range(60)}
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_edits(docs(list(texts.items()))).collect()}
    errors = []
    for i, t in texts.items():
        q, own = len(t) // 4, collections.Counter(t.split())
        after = texts[(i + 1) % 60]
        for name, other in (("near_edited", t[:len(t) - q] + after[:q]), ("near_next", after)):
            bag = collections.Counter(other.split())
            errors.append(got[i][name] - (own & bag).total() / (own | bag).total())
    assert all(len(r["fingerprint"]) >= 8 * 40 for r in got.values())
    assert math.sqrt(sum(e * e for e in errors) / len(errors)) < 0.065
