"""BPE encoding and decoding with a tokenization automaton.

The merge list is compiled into a deterministic automaton over token labels by
adding one merge gadget after another. The automaton starts with one state that
loops on every base symbol. The gadget of merge ``(u, v) -> uv``

* sends every ``u`` arc to a fresh copy of its old target that lacks the ``v``
  arc (``u v`` side by side is no longer a tokenization), and
* adds a ``uv`` arc, beside every ``u`` arc, to the old target of ``v``.

All arcs with one label lead to one state, so an automaton state is stored as
(label that leads to it, missing label, time of birth) and the arc table is
filled on demand. Exactly one path of the finished automaton spells a given word, so a
word is encoded by one left-to-right pass over its symbols, without ranks or a
priority queue. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import json
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from struct import pack, unpack

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tessera.llm.common import arrow_map, slices

SUFFIX = "</w>"
ARC_CACHE = 500_000
WORD_CACHE = 300_000
CACHED_CHARS = 64
TABLE_ROWS = 250_000
LONG_WORD = 256


def byte_alphabet() -> list[str]:
    """Printable stand-in of each byte: printable Latin-1 keeps itself, the rest follow from U+0100."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    shifted = iter(range(0x100, 0x200))
    return [chr(b if b in keep else next(shifted)) for b in range(256)]


class Automaton:
    """Deterministic automaton of the correct tokenizations under a merge list."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = SUFFIX):
        self.labels = {i: t for t, i in vocab.items()}
        self.left: dict[int, int] = {}
        self.born: dict[int, int] = {}
        self.target: dict[int, int] = {}
        self.state_born, self.state_of = [0], [-1]
        self.copies: dict[int, tuple[list[int], list[int]]] = {}  # of a label's target: births and states
        self.origin: dict[int, int] = {}
        self.merged: dict[int, int] = {}
        self.arcs: dict[int, bool] = {}
        for k, (u, v) in enumerate(merges, 1):
            self._gadget(vocab[u], vocab[v], vocab[u + v], k)
        self.rows: dict[bytes, int] = {b"": 0}
        symbol = {c: i for i, c in enumerate(byte_alphabet())}
        self.ends, self.ending = {}, [-1]  # labels read from their ends; the label that a node spells
        for t, i in vocab.items():
            last = t.endswith(suffix) and t != suffix
            spelt = [symbol[c] for c in t.removesuffix(suffix)] if last else [symbol[c] for c in t]
            if len(spelt) > 1 and i not in self.born:
                continue  # no arc carries it
            spelt[-1] += 256 * last
            node = 0
            for c in reversed(spelt):
                node = self.ends.setdefault(node << 9 | c, len(self.ending))
                if node == len(self.ending):
                    self.ending.append(-1)
            self.ending[node] = i

    def _gadget(self, u: int, v: int, uv: int, k: int) -> None:
        r, s = self.target.get(u, 0), self.target.get(v, 0)
        if uv in self.born or not self.allows(r, v):
            return  # the pair cannot stand side by side any more
        self.left[uv], self.born[uv], self.target[uv], self.origin[uv] = u, k, s, s
        self.target[u] = len(self.state_born)
        births, states = self.copies.setdefault(u, ([], []))
        births.append(k)
        states.append(len(self.state_born))
        self.state_born.append(k)
        self.state_of.append(u)
        self.merged[u << 20 | v] = k

    def allows(self, q: int, t: int) -> bool:
        """Whether state ``q`` has an arc labelled ``t``.

        A state other than the start is a copy, made by a merge ``(u, v)``, of
        the target of ``u``: it has the arcs of the copy before it but for ``v``.
        """
        key = q << 20 | t
        while q:
            time = self.born.get(t, 0)
            if self.state_born[q] <= time:
                t = self.left[t]  # an arc uv stands wherever u stood
                continue
            u = self.state_of[q]
            if self.merged.get(u << 20 | t, self.state_born[q] + 1) <= self.state_born[q]:
                break
            births, states = self.copies[u]
            older = bisect_right(births, time)  # copies made after the label carry it as their originals do
            q = states[older - 1] if older else self.origin.get(u, 0)
        if len(self.arcs) >= ARC_CACHE:
            self.arcs.clear()
        self.arcs[key] = not q
        return not q

    def step(self, word: bytes, last: int) -> int:
        """The row of ``word``, whose last symbol is ``last``, from those of its beginnings.

        The labels that end here are read backwards; exactly one of them fits
        the state where it starts. A row is one number, which a table of many
        holds in a fraction of a tuple's memory: the state, where the last label
        starts and that label.
        """
        ends, arcs, ending, rows, lo = self.ends.get, self.arcs.get, self.ending, self.rows, len(word) - 1
        node = ends(last)
        while True:
            if (t := ending[node]) >= 0:
                q = rows[word[:lo]] >> 30
                fits = arcs(q << 20 | t)
                if self.allows(q, t) if fits is None else fits:
                    return self.target.get(t, 0) << 30 | lo << 20 | t
            lo -= 1
            node = ends(node << 9 | word[lo])

    def encode(self, word: bytes) -> tuple[int, ...]:
        """Token ids of a word; its last byte carries the word end.

        ``rows`` is the table of the beginnings met so far: one that an earlier
        word had costs no step.
        """
        rows, n = self.rows, len(word)
        if n > LONG_WORD:
            return self.encode_long(word)
        if len(rows) > TABLE_ROWS:
            rows.clear()
            rows[b""] = 0
        have = n - 1
        while word[:have] not in rows:
            have -= 1
        for hi in range(have + 1, n):
            rows[word[:hi]] = self.step(word[:hi], word[hi - 1])
        row, out = self.step(word, word[-1] | 256), []
        while True:
            out.append(row & 0xFFFFF)
            lo = row >> 20 & 0x3FF
            if not lo:
                return tuple(out[::-1])
            row = rows[word[:lo]]

    def encode_long(self, word: bytes) -> tuple[int, ...]:
        """``encode`` with the states of one word's beginnings in a list: time and memory linear in its length."""
        symbols, path, back = [*word[:-1], word[-1] | 256], [0], [(0, 0)]
        for hi in range(1, len(word) + 1):
            node, lo = 0, hi
            while len(path) == hi:
                lo -= 1
                node = self.ends[node << 9 | symbols[lo]]
                if (t := self.ending[node]) >= 0 and self.allows(path[lo], t):
                    path.append(self.target.get(t, 0))
                    back.append((lo, t))
        out, at = [], len(word)
        while at:
            at, t = back[at]
            out.append(t)
        return tuple(out[::-1])


class Tokenizer:
    """Normaliser, word splitter and automaton of one tokenizer file, with a bounded cache of words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.automaton = Automaton(model["vocab"], [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]],
                                   model["end_of_word_suffix"] or "")
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = self.automaton.labels | {i: c for c, i in self.specials.items()}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.find = regex.compile(split["pattern"]["Regex"]).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")").split
        self.blank = regex.compile(r"\p{White_Space}+").sub
        self.marks = sorted({c[:2] for c in self.specials})
        self.separators = regex.compile(r"[\x1c-\x1f]").search
        self.known: dict[str, bytes] = {}

    def forget(self) -> None:
        """Empty the caches: a worker that waits for other work holds the tables alone."""
        self.known.clear()
        self.automaton.arcs.clear()
        self.automaton.rows.clear()
        self.automaton.rows[b""] = 0

    def word(self, w: str) -> bytes:
        ids = self.automaton.encode(w.encode())
        return pack(f"<{len(ids)}I", *ids)

    def chunk(self, c: str) -> bytes:
        """A run of text without white space: its words one after another."""
        known = self.known
        if c.isalpha() or len(found := self.find(c)) == 1 and found[0] == c:
            out = self.word(c)
        else:
            out = b"".join([known.get(w) or self.chunk(w) for w in found])
        if len(c) <= CACHED_CHARS:
            if len(known) >= WORD_CACHE:
                known.clear()
            known[c] = out
        return out

    def normalise(self, text: str) -> str:
        if not text.isascii():
            text = self.blank(" ", unicodedata.normalize("NFC", text))
        low = text.lower()
        return low if "Σ" not in text else "".join([c.lower() for c in text])

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids of a text."""
        parts: list[bytes] = []
        get, chunk = self.known.get, self.chunk
        for piece in self.cut(text) if any(m in text for m in self.marks) else [text]:
            if piece in self.specials:
                parts.append(pack("<I", self.specials[piece]))
                continue
            low = self.normalise(piece)
            # str.split() also cuts at U+001C to U+001F, which are no white space here.
            cuts = low.split() if not self.separators(low) else [low]
            parts += [get(c) or chunk(c) for c in cuts]
        return b"".join(parts)

    def decode(self, ids: bytes) -> str:
        """The arc labels of a sequence of ids, joined by spaces."""
        return " ".join([self.labels[i] for i in unpack(f"<{len(ids) // 4}I", ids)])


@lru_cache(maxsize=2)
def load(path: str) -> Tokenizer:
    return Tokenizer(path)


def _strings(values) -> pa.Array:
    return pa.array(values, pa.string())


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", decoded: bool = True) -> DataFrame:
    """``key``, ``n_tokens``, ``ids`` (packed little-endian 32-bit) and, if asked for, ``decoded``.

    One row per input row, in no order. A null or empty text has no tokens and
    decodes to the empty text; a null key, a repeated key or a repeated row is
    kept as it is; an empty table gives no rows; other columns are dropped, whatever their names. ``path``
    names the tokenizer file on every worker. Memory is bounded by one slice of
    a batch (or one text) and bounded caches, which end with the task.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load(path)
        try:
            for b in slices(batches, "text", 2 << 20):
                got = [tok.encode(t or "") for t in b.column(1).to_pylist()]
                cols = [b.column(0), pa.array([len(i) // 4 for i in got], pa.int64()), pa.array(got, pa.binary())]
                names = [key, "n_tokens", "ids"]
                if decoded:
                    cols, names = [*cols, _strings([tok.decode(i) for i in got])], [*names, "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names)
        finally:
            tok.forget()

    return arrow_map(docs.select(docs[key], docs[text].alias("text")), run,
                     f"`{key}` {kind}, n_tokens bigint, ids binary" + ", decoded string" * decoded)


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and ``decoded``: the labels of packed ids, joined by spaces (null or empty: empty text)."""
    kind = encoded.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load(path)
        for b in slices(batches, "ids"):
            yield pa.RecordBatch.from_arrays([b.column(0), _strings([tok.decode(i or b"") for i in b.column(1).to_pylist()])], [key, "decoded"])

    return arrow_map(encoded.select(encoded[key], encoded[ids].alias("ids")), run, f"`{key}` {kind}, decoded string")
