"""Secrets: base rules, and formats learned by grammar inference.

Credentials that the base rules confirm are labelled examples. For each kind of
credential a prefix tree of character classes is built from a bounded sample and
its states are merged where their outgoing frequencies are statistically
compatible (the ALERGIA test with a Hoeffding bound), which leaves a
probabilistic automaton of the format. An automaton of the background is built
alike from strings that no rule confirms and that several texts share: a secret
that nobody labelled stands in one text, and must not make its own format look
ordinary. Every string of the characters of
credentials that is as long as the shortest example of a kind is then scored,
over all its characters, and counts as a secret if the automaton of the kind
finds it as likely as nearly all of its own examples, and likelier than the
background does, weighed by how many strings there are of either.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, schema_of, slices, staged

#: Base kinds in their order, then the kind that the method adds.
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "format")

_ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_CUES = re.compile("passw|secret|token|api_?key", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Strings that may be secrets: of the characters of ``assign`` values, but for dots at either end.
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-](?:[A-Za-z0-9+/_.=-]*[A-Za-z0-9+/_=-])?")
#: No base rule confirms a shorter value.
SHORTEST = 6

#: Parameter: examples of each kind that an automaton is fitted to, by least hash.
EXAMPLES = 2000
#: Parameter: longer examples are not fitted to (strings of any length are scored).
LONGEST = 512
#: Strings of the background stand in so many texts at least: what is written once may be an unlabelled secret.
COMMON = 2
#: Parameter: an automaton of ``n`` examples is believed as if it had a prior weight of ``n / (n + DOUBT)``.
DOUBT = 20
CONFIDENCE = 0.05


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, value)`` of the base rules, by start and kind."""
    out = []
    if _CUES.search(text):
        out += [(m.start(), m.end(), "assign", m[1]) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access", m[0]) for m in _ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex", m[0]) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


_CLASSES = str.maketrans({chr(c): "d" if chr(c).isdigit() else "h" if chr(c) in "abcdef" else "l" if chr(c).islower() else "X" if chr(c) in "ABCDEF" else "U"
                          for c in range(128) if chr(c).isalnum()})


def symbols(value: str) -> str:
    """Character classes of a string: hexadecimal digits, other letters by case, digits, and marks as they are."""
    return value.translate(_CLASSES)


def free(text: str, taken: list[tuple[int, int]], shortest: int) -> Iterator[tuple[int, int, str]]:
    """``(start, stop, value)`` of the candidates of at least ``shortest`` characters that meet none of the sorted spans ``taken``."""
    ends, top = [], 0
    for _, e in taken:
        top = max(top, e)
        ends.append(top)
    starts = [s for s, _ in taken]
    for m in _CANDIDATE.finditer(text):
        s, e = m.span()
        if e - s >= shortest:
            i = bisect_left(starts, e)
            if not i or ends[i - 1] <= s:
                yield s, e, m[0]


class Automaton:
    """Probabilistic automaton of a format, grown from a prefix tree by compatible merges."""

    def __init__(self, examples: list[str], confidence: float = CONFIDENCE):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[Counter] = [Counter()]  # of symbols read in a state; "" counts ends
        for word in examples:
            q = 0
            for c in word:
                self.count[q][c] += 1
                if c not in self.next[q]:
                    self.next[q][c] = len(self.next)
                    self.next.append({})
                    self.count.append(Counter())
                q = self.next[q][c]
            self.count[q][""] += 1
        self.bound = math.sqrt(math.log(2 / confidence) / 2)
        self._merge()
        self._prune()

    def _differ(self, a: int, b: int) -> bool:
        n, m = self.count[a].total(), self.count[b].total()
        if not n or not m:
            return False
        limit = self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
        return any(abs(self.count[a][c] / n - self.count[b][c] / m) >= limit for c in self.count[a].keys() | self.count[b].keys())

    def _compatible(self, a: int, b: int) -> bool:
        """Whether two states and all that follows them have like frequencies."""
        todo, seen = [(a, b)], set()
        while todo:
            x, y = todo.pop()
            if (x, y) in seen or x == y:
                continue
            seen.add((x, y))
            if self._differ(x, y):
                return False
            todo += [(self.next[x][c], self.next[y][c]) for c in self.next[x].keys() & self.next[y].keys()]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Merge the tree below ``b`` into state ``a``."""
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            if x == y:
                continue
            self.count[x] += self.count[y]
            for c, z in self.next[y].items():
                if c in self.next[x]:
                    todo.append((self.next[x][c], z))
                else:
                    self.next[x][c] = z

    def _merge(self) -> None:
        red, blue = [0], [(0, c) for c in sorted(self.next[0])]
        while blue:
            p, c = blue.pop(0)
            b = self.next[p][c]
            if b in red:
                continue
            for r in red:
                if self._compatible(r, b):
                    self.next[p][c] = r
                    self._fold(r, b)
                    break
            else:
                red.append(b)
            blue = [(r, c) for r in red for c in sorted(self.next[r]) if self.next[r][c] not in red]

    def _prune(self) -> None:
        """Keep the states that can be reached, which merges have left few of, under new numbers."""
        number, todo = {0: 0}, [0]
        for q in todo:
            for c in sorted(self.next[q]):
                if self.next[q][c] not in number:
                    number[self.next[q][c]] = len(todo)
                    todo.append(self.next[q][c])
        self.next = [{c: number[z] for c, z in self.next[q].items()} for q in todo]
        self.count = [self.count[q] for q in todo]

    def score(self, word: str) -> float:
        """Log likelihood per symbol, the end included; each state keeps a little for symbols it has not seen."""
        q, total = 0, 0.0
        for c in [*word, ""]:
            if q is None:
                total += math.log(0.002)
                continue
            seen = self.count[q]
            total += math.log((seen[c] + 0.02) / (seen.total() + 0.02 * 12))
            q = self.next[q].get(c) if c else q
        return total / (len(word) + 1)


class Models:
    """An automaton of each kind with its least score, shortest example and weight, and one of the background."""

    def __init__(self, examples: list[tuple[str, str]], background: list[str] = (), share: dict[str, float] | None = None):
        """``share``: how many labelled strings of a kind there are for each string of the background."""
        self.kinds = []
        for kind in BASE:
            words = sorted(symbols(v) for k, v in examples if k == kind)
            if words:
                found = Automaton(words)
                scores = sorted(found.score(w) for w in words)
                # 95 of 100 of its examples reach the least score
                weight = math.log((share or {}).get(kind, 1.0)) + math.log(len(words) / (len(words) + DOUBT))
                self.kinds.append((found, scores[len(scores) // 20], min(map(len, words)), weight))
        self.background = Automaton(sorted(map(symbols, background))) if self.kinds and background else None
        self.shortest = min((n for _, _, n, _ in self.kinds), default=0)
        self.known: dict[str, bool] = {}

    def accepts(self, value: str) -> bool:
        word = symbols(value)
        got = self.known.get(word)
        if got is None:
            got = self._decide(word)
            if len(word) <= 64 and len(self.known) < 200_000:
                self.known[word] = got
        return got

    def _decide(self, word: str) -> bool:
        other = None
        for model, least, shortest, weight in self.kinds:
            if len(word) >= shortest and (own := model.score(word)) >= least:
                if self.background is None:
                    return True
                other = self.background.score(word) if other is None else other
                if (own - other) * (len(word) + 1) + weight > 0:
                    return True
        return False


_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.string())])


def labelled(docs: DataFrame, text: str = "text", examples: int = EXAMPLES) -> DataFrame:
    """``kind``, ``value`` and ``n`` of all base spans and, of each batch, the ``examples`` other strings of least hash.

    ``n`` of another string counts the texts that hold it; as all batches choose
    by the same hash, the sums of the strings of least hash are whole. A row
    without a value counts all other strings of a batch.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "__text"):
            rows, others, n = Counter(), Counter(), 0
            for t in b.column(0).to_pylist():
                found = base_spans(t) if t else []
                rows.update((k, v) for _, _, k, v in found)
                strings = [v for _, _, v in free(t, [(s, e) for s, e, _, _ in found], SHORTEST)] if t else []
                others.update(set(strings))
                n += len(strings)
            least = heapq.nsmallest(examples, others, key=lambda v: (zlib.crc32(v.encode()), v))
            out = [*((k, v, c) for (k, v), c in rows.items()), *(("other", v, others[v]) for v in least), ("other", None, n)]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.string(), pa.string(), pa.int64()))], ["kind", "value", "n"])

    return arrow_map(docs.select(docs[text].alias("__text")), run, "kind string, value string, n bigint")


def detect(docs: DataFrame, keep: list[str], text: str = "text", examples: int = EXAMPLES) -> DataFrame:
    """``keep`` and ``spans`` (``start``, ``stop``, ``kind``), by start and kind, of every row.

    Offsets are code points, the end exclusive. A null or empty text has no
    spans; null keys, repeated keys and repeated rows are kept as they are;
    columns not in ``keep`` are dropped; an empty table gives no rows. A kind is
    learned from its first example on; few examples weigh less against the
    background (``DOUBT``), which is learned from strings of several texts. The driver sees ``examples`` distinct values of a
    kind, and of the background, at most: those of least hash among those of
    ``LONGEST`` characters at most. All candidates, of any length, are scored,
    whole.
    """
    found = staged(labelled(docs, text, examples), "secrets")
    whole = found.where("kind <> 'other' OR value IS NULL")
    counts = {r["kind"]: r["n"] for r in whole.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    values = found.where(F.length("value") <= LONGEST).groupBy("kind", "value").agg(F.sum("n").alias("n")).where(f"kind <> 'other' OR n >= {COMMON}")
    rows = []
    for kind in (*BASE, "other"):
        least = values.where(F.col("kind") == kind).orderBy(F.crc32(F.col("value").cast("binary")), "value").limit(examples)
        rows += [(r["kind"], r["value"]) for r in least.collect()]
    models = Models(rows, [v for k, v in rows if k == "other"], {k: max(1, counts.get(k, 0)) / max(1, counts.get("other", 0)) for k in BASE})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "__text"):
            out = []
            for t in b.column(b.num_columns - 1).to_pylist():
                kept = [(s, e, k) for s, e, k, _ in base_spans(t)] if t else []
                if t and models.kinds:
                    taken = [(s, e) for s, e, _ in kept]
                    kept += [(s, e, "format") for s, e, v in free(t, taken, models.shortest) if models.accepts(v)]
                    kept.sort(key=lambda x: (x[0], KINDS.index(x[2])))
                out.append([{"start": s, "stop": e, "kind": k} for s, e, k in kept])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, pa.list_(_SPAN))], [*keep, "spans"])

    return arrow_map(docs.select(*[docs[k] for k in keep], docs[text].alias("__text")), run,
                     schema_of(docs, keep, "spans array<struct<start: bigint, stop: bigint, kind: string>>"))
