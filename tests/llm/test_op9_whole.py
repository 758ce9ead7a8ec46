"""Strings are judged over all their characters, and a background model decides instead of tests before it."""

import random

from tessera.llm import secrets

from .test_operators import prose


def test_what_follows_a_long_beginning_counts():
    r = random.Random(6)
    key = lambda n, a="0123456789abcdef": "".join(r.choices(a, k=n))
    words = [key(r.randint(300, 340)) for _ in range(60)]
    assert len({secrets.symbols(w[:256] + x) for x in ("a1", "zz") for w in words[:1]}) == 2
    models = secrets.Models([("hex", w) for w in words])
    assert models.accepts(key(310)) and not models.accepts(key(200) + "Z" * 110)


def test_background_decides_on_short_and_dotted_values_and_those_without_digits(docs):
    r = random.Random(7)
    key = lambda: "".join(r.choices("GHJKLMNPQRSTUVWXYZ", k=5)) + "." + "".join(r.choices("GHJKLMNPQRSTUVWXYZ", k=6))
    rows = [(i, f"{prose(30, i)} token = {key()} {prose(5, i)}") for i in range(80)]
    free = key()
    rows += [(100, f"{prose(20, 1)} {free} {prose(9, 2)} internationalisation")]
    got = {x["doc_id"]: x["spans"] for x in secrets.detect(docs(rows), ["doc_id"]).collect()}
    text = rows[-1][1]
    assert [(s["kind"], text[s["start"]:s["stop"]]) for s in got[100]] == [("format", free)]
    assert all([s["kind"] for s in got[i]] == ["assign"] for i in range(80))
