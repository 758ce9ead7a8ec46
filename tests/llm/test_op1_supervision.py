"""Planted personal data and decoys: precision and recall of added spans, whole addresses, long texts."""

import random
import time

from tessera.llm import pii

RNG = random.Random(8)
NOUNS = "river garden window market bridge letter summer valley number paper music winter forest".split()


def filler(n):
    return " ".join(RNG.choice(NOUNS) for _ in range(n))


def planted():
    """(text, personal spans as text) and decoys without any."""
    rows = []
    for i in range(120):
        name = RNG.choice("Mr Mrs Dr Prof".split()) + " " + "".join(RNG.choices("BKLMNRST")) + "".join(RNG.choices("aeioulnr", k=6))
        rows.append((f"{filler(9)} signed {name} {filler(6)}", [name]))
        number = f"{RNG.randint(100, 665)}-{RNG.randint(10, 99)}-{RNG.randint(1000, 9999)}"
        rows.append((f"{filler(8)} her ssn is {number} {filler(5)}", [number]))
        phone = f"{RNG.randint(200, 999)}-{RNG.randint(200, 999)}-{RNG.randint(1000, 9999)}"
        rows.append((f"{filler(8)} phone {phone} {filler(5)}", [phone]))
    decoys = [f"{filler(7)} part 123-45-{i:04d} {filler(6)}" for i in range(300)] + [f"{filler(7)} 111-111-1111 {filler(3)}" for _ in range(40)]
    return rows, decoys + [f"{filler(5)} invoice 204-55-{i:04d}" for i in range(1, 100)]


def test_precision_and_recall_of_added_spans(docs):
    rows, decoys = planted()
    texts = [t for t, _ in rows] + decoys
    table = docs(list(enumerate(texts)))
    got = {r.doc_id: [texts[r.doc_id][s.start:s.stop] for s in r.spans] for r in pii.detect(table, ["doc_id"]).collect()}
    true = sum(len(set(got[i]) & set(want)) for i, (_, want) in enumerate(rows))
    found = sum(map(len, got.values()))
    assert true >= 0.98 * sum(len(w) for _, w in rows) and true >= 0.98 * found
    clean = {r.doc_id: r.text for r in pii.redact(table).collect()}
    assert all(clean[i] == t for i, t in enumerate(texts) if not got[i])


def test_unknown_names_and_bare_numbers(docs):
    """Names outside the gazetteer are found by their titles; numbers in the form of an identity number, without a cue, are left alone."""
    rows = [(i, f"{filler(6)} Dr Zq{chr(97 + i % 26)}rt Vol{i}ma {filler(6)}") for i in range(300)] + [(1000 + i, f"{filler(5)} 123-45-{i:04d} {filler(5)}") for i in range(1, 600)]
    got = {r.doc_id: [s.kind for s in r.spans] for r in pii.detect(docs(rows), ["doc_id"]).collect()}
    assert all(got[i] == ["person"] for i in range(300)) and not any(got[1000 + i] for i in range(1, 600))


def test_spelled_addresses_are_found_whole():
    for a in ("j [at] example [dot] com", "jo_doe+x [at] example.org", "x" * 70 + " [at] mail [dot] example [dot] com", "jo.doe [at] mail [dot] example [dot] com", "a%b(at)c(dot)d"):
        text = f"write to {a} now"
        assert [text[s:e] for s, e, *_ in pii.candidates(text, [])] == [a]


def test_context_is_learned_from_both_sides(docs):
    """Numbers that no cue names stand where those with a cue stand: the words after them decide."""
    rows = [(i, f"{filler(4)} ssn 1{i % 90 + 10}-45-{1000 + i} {'on file for the taxpayer'} {filler(3)}") for i in range(200)]
    rows += [(1000 + i, f"{filler(4)} lot 2{i % 90 + 10}-45-{1000 + i} shipped in boxes {filler(3)}") for i in range(200)]
    rows += [(2000 + i, f"{filler(4)} 3{i % 90 + 10}-45-{1000 + i} {'on file' if i % 2 else 'shipped in'} {filler(4)}") for i in range(40)]
    got = {r.doc_id: bool(r.spans) for r in pii.detect(docs(rows), ["doc_id"]).collect()}
    assert all(got[i] for i in range(200)) and not any(got[1000 + i] for i in range(200))
    assert sum(got[2000 + i] == bool(i % 2) for i in range(40)) >= 36


def test_a_long_dense_text_takes_linear_time():
    def seconds(n):
        text = " ".join(f"a{i}@ex{i}.com 415-555-{1000 + i % 9000} b{i} [at] c [dot] de 123-45-{1000 + i % 9000}" for i in range(n))
        t = time.process_time()
        assert len(pii.candidates(text, pii.base_spans(text))) == 3 * n
        return time.process_time() - t
    seconds(200)
    assert seconds(16_000) < 8 * max(seconds(4_000), 0.05)
