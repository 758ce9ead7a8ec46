"""Formats learned from labelled secrets, found where no rule names them: precision and recall, few and long examples."""

import random

import pytest

from tessera.llm import secrets

from .test_operators import prose

R = random.Random(11)


def key():
    return "sk_" + "".join(R.choices("GHJKLMNPQRSTUVWXYZ23456789", k=8)) + "-" + "".join(R.choices("0123456789", k=6))


@pytest.mark.parametrize("examples", [3, 19, 20, 60])
def test_formats_outside_the_cues(docs, examples):
    """No switch at a number of examples: secrets without a cue are found, other strings of the texts left alone."""
    rows = [(i, f"{prose(25, i)} token: {key()} {prose(9, i)} order-{1000 + i} v{i}.2.1") for i in range(examples)]
    free = {1000 + i: key() for i in range(40)}
    rows += [(i, f"{prose(20, i)} {k} {prose(12, i)} item_{i} 2024-11-{i % 28 + 1:02d} WINTER-{i} {'x' * 9}") for i, k in free.items()]
    texts = dict(rows)
    got = {r.doc_id: [texts[r.doc_id][s.start:s.stop] for s in r.spans if s.kind == "format"] for r in secrets.detect(docs(rows), ["doc_id"]).collect()}
    right = sum(got[i] == [k] for i, k in free.items())
    assert right >= 0.9 * len(free)
    assert sum(map(len, got.values())) <= right + 0.05 * len(rows)


def test_long_examples_are_left_out_of_the_fit_only(docs):
    long = "".join(R.choices("ABCDEF0123456789", k=5000))
    rows = [(i, f"secret={key()} {prose(12, i)}") for i in range(30)] + [(100, f"password = {long} {prose(5, 1)}"), (101, f"{prose(4, 2)} {key()}")]
    got = {r.doc_id: r.spans for r in secrets.detect(docs(rows), ["doc_id"]).collect()}
    assert [(s.kind, s.stop - s.start) for s in got[100]] == [("assign", 11 + 5000)] and [s.kind for s in got[101]] == ["format"]


def test_an_automaton_keeps_no_dead_states():
    a = secrets.Automaton([secrets.symbols(key()) for _ in range(300)])
    seen, todo = {0}, [0]
    for q in todo:
        for z in a.next[q].values():
            if z not in seen:
                seen.add(z)
                todo.append(z)
    assert seen == set(range(len(a.next))) and len(a.next) == len(a.count) < 60
