"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Base kinds (e-mail, ip, card, phone) follow fixed rules and always count. The
method adds spans of other kinds: candidate spans are cut from the text by loose
patterns, and labelers vote for, against or not at all on each of them: forms
(checksums, number plans, titles), gazetteers (given names, street words), cue
words and counter cues (part, order, invoice) beside a span, base spans nearby,
repetition. Votes are counted over the whole corpus; expectation-maximisation
estimates, for each kind by itself, how reliable each labeler is and how common
personal data is. A naive Bayes span classifier is then trained on these soft
labels with features that no labeler sees: the words before and after a span and
its shape, learned from all candidates and, as certain examples of the kind they
resemble, from base spans. It decides on every candidate. Candidates that overlap
a base span are left to the base rules.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, schema_of, slices, staged

#: Base kinds in their order, then the kinds that the method adds.
BASE = ("email", "ip", "card", "phone")
ADDED = ("email_words", "id_number", "iban", "local_phone", "person", "address")
KINDS = (*BASE, *ADDED)

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){11,}")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = str.maketrans("", "", " ().-+")


def luhn(digits: str) -> bool:
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the e-mail rule, found from each ``@``: linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            done = m.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the base kinds, by start and kind."""
    out = [(s, e, "email") for s, e in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        digits = m[0].translate(_DIGITS)
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(m[0].translate(_DIGITS)) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


# Gazetteers and cue words.
TITLES = "Mr Mrs Ms Miss Dr Prof Sir Madame Mme Monsieur Herr Frau Señor Señora Sr Sra Doña Don".split()
GIVEN = frozenset("""james john robert michael william david richard joseph thomas charles mary patricia jennifer linda elizabeth
barbara susan jessica sarah karen anna maria peter paul hans karl heinrich klaus ursula monika sabine pierre jean michel marie
sophie claire antonio manuel josé francisco carmen lucía isabel pablo""".split())
STREETS = "street st avenue ave road rd lane boulevard blvd drive straße strasse weg platz rue calle avenida plaza".split()
CUES = {
    "email_words": frozenset("email mail e-mail contact write reach correo courriel".split()),
    "id_number": frozenset("ssn social security id passport tax dni nie steuer insee national".split()),
    "iban": frozenset("iban account bank konto cuenta compte".split()),
    "local_phone": frozenset("phone tel telephone call mobile cell fax telefon teléfono téléphone appelez".split()),
    "person": frozenset("name named dear regards signed sincerely contact by from herr frau".split()),
    "address": frozenset("address lives at resident home live located wohnt adresse dirección".split()),
}
COUNTER_CUES = frozenset("part parts item items sku model serial order invoice product catalog version isbn lot batch article section figure table no nr".split())
CANDIDATES = {
    "id_number": re.compile(r"(?<![\w.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,4})?(?!\w)"),
    "local_phone": re.compile(r"(?<![\w.+-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![\w-])"),
    "person": re.compile(r"(?<!\w)(?:" + "|".join(TITLES) + r")\.?\x20[A-ZÀ-Þ][\w'-]+(?:\x20[A-ZÀ-Þ][\w'-]+)?"),
    "address": re.compile(r"(?<!\w)[0-9]{1,5}\x20(?:[A-ZÀ-Þ][\w'-]+\x20){1,3}(?:" + "|".join(STREETS) + r")\b\.?", re.I),
}
#: Strings without which no candidate of the kind can be, tested before the pattern.
NEEDS = {"id_number": ("-",), "person": tuple(f"{t}{e}" for t in TITLES for e in (" ", ".")), "address": ()}
#: The middle of a spelled address, in any case and spacing, and the domain after it.
_AT = re.compile(r"\s?[\[(]\s?at\s?[\])]\s?", re.I)
_SPELLED = re.compile(r"[A-Za-z0-9-]++(?:(?:\s?[\[(]\s?dot\s?[\])]\s?|\.)[A-Za-z0-9-]++)+", re.I)
LABELERS = ("form", "gazetteer", "cue", "counter", "near_base", "repetitive")
_TOKEN = re.compile(r"[\w-]+")
_DIGIT = re.compile("[0-9]")
_PLAN = re.compile(r"^\(?[2-9][0-9]{2}\D{1,2}[2-9]")
#: Context words fall into so many buckets a side; a kind has these and its shapes as features.
BUCKETS = 4096
SHAPES = 5 * 5 * 7
_STRIDE = 2 * BUCKETS + SHAPES
#: What a base kind is a certain example of.
LIKE = {"email": "email_words", "phone": "local_phone"}
#: Context counts for no more than this in the log odds, so that it cannot outvote all labelers.
CONTEXT = 4.0


def _iban_ok(span: str) -> bool:
    s = span.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _form(kind: str, span: str) -> int:
    """The labeler of checksums, number plans and titles. A plain run of digits in groups proves nothing by itself."""
    if kind == "iban":
        return 1 if _iban_ok(span) else -1
    if kind == "id_number":
        return -1 if span[:3] in ("000", "666") or span[0] == "9" or span[4:6] == "00" or span[7:] == "0000" else 0
    if kind == "local_phone":
        return 1 if _PLAN.match(span) else -1
    return 0 if kind == "address" else 1


class Covered:
    """Base spans of a text as disjoint intervals, searched by bisection."""

    def __init__(self, base: list[tuple[int, int, str]]):
        self.starts, self.ends = [], []
        for s, e, _ in base:  # by start
            if self.ends and s <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def within(self, start: int, end: int, reach: int = 0) -> bool:
        """Whether a base span overlaps ``[start - reach, end + reach)``."""
        k = bisect_right(self.ends, start - reach)
        return k < len(self.starts) and self.starts[k] < end + reach


def votes(text: str, start: int, end: int, kind: str, covered: Covered, before: list[str], after: list[str]) -> tuple[int, ...]:
    """Votes of ``LABELERS``: 1 for, -1 against, 0 none."""
    span = text[start:end]
    tokens = [t.lower() for t in _TOKEN.findall(span)]
    gazetteer = 0
    if kind == "person":
        gazetteer = 1 if any(t in GIVEN for t in tokens) else 0
    elif kind == "address":
        gazetteer = 1 if tokens and tokens[-1] in STREETS and span[span.index(" ") + 1].isupper() else -1
    cue = 1 if any(t in CUES[kind] for t in before + after[:2]) else 0
    counter = -1 if any(t in COUNTER_CUES for t in before[-2:]) else 0
    near = 1 if covered.within(start, end, 80) else 0
    repetitive = -1 if len({c for c in span if c.isalnum()}) <= 2 else 0
    return _form(kind, span), gazetteer, cue, counter, near, repetitive


def _beside(text: str, start: int, end: int) -> tuple[list[str], list[str]]:
    before = [t.lower() for t in _TOKEN.findall(text[max(0, start - 48):start])[-5:]]
    return before, [t.lower() for t in _TOKEN.findall(text[end:end + 32])[:3]]


def features(kind: str, span: str, before: list[str], after: list[str]) -> list[int]:
    """Numbers of the classifier's features: words before, words after, shape."""
    first, n = ADDED.index(kind) * _STRIDE, max(1, len(span))
    digits, letters = sum(c.isdigit() for c in span), sum(c.isalpha() for c in span)
    shape = (4 * digits // n * 5 + 4 * letters // n) * 7 + min(6, n.bit_length())
    words = {zlib.crc32(w.encode()) % BUCKETS for w in before[-3:]} | {BUCKETS + zlib.crc32(w.encode()) % BUCKETS for w in after[:2]}
    return [first + x for x in sorted(words)] + [first + 2 * BUCKETS + shape]


def _spelled(text: str) -> Iterator[tuple[int, int]]:
    """Addresses with a spelled at sign, leftmost first, whole: found from the sign outwards, linear in the text."""
    done = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if m.start() >= done and start < m.start() and (rest := _SPELLED.match(text, m.end())):
            done = rest.end()
            yield start, done


def candidates(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str, tuple[str, list[int]]]]:
    """``(start, end, kind, (votes, features))`` of the spans that the method may add."""
    out, covered = [], Covered(base)
    has_digit = _DIGIT.search(text) is not None
    found = [(s, e, "email_words") for s, e in _spelled(text)]
    for kind, rule in CANDIDATES.items():
        if kind != "person" and not has_digit or (need := NEEDS.get(kind)) and not any(x in text for x in need):
            continue
        found += [(*m.span(), kind) for m in rule.finditer(text)]
    for s, e, kind in found:
        if not covered.within(s, e):
            before, after = _beside(text, s, e)
            v = votes(text, s, e, kind, covered, before, after)
            out.append((s, e, kind, (",".join(map(str, v)), features(kind, text[s:e], before, after))))
    return out


def expectation_maximisation(patterns: list[tuple[tuple[int, ...], float]], rounds: int = 50) -> tuple[list[float], list[list[dict]]]:
    """Posterior of each vote pattern, and each labeler's vote shares ``[against truth 0, truth 1]``.

    ``patterns``: votes and how often they occur. Labelers are taken as
    independent given the truth; an abstention is a vote of its own. Starts from
    the majority, less half a vote, as what nobody vouches for is more often
    harmless; every share is smoothed, so no labeler is ever certain.
    """
    n = len(patterns[0][0]) if patterns else 0
    post = [1 / (1 + 4.0 ** (0.5 - sum(v))) for v, _ in patterns]
    shares: list[list[dict]] = []
    for _ in range(rounds):
        weight = sum(c for _, c in patterns)
        prior = (1 + sum(p * c for p, (_, c) in zip(post, patterns))) / (3 + weight)
        shares = []
        for j in range(n):
            share = []
            for truth in (0, 1):
                # a labeler is believed better than chance before it has been seen
                count = {v: 2.0 if (v > 0) == truth and v else 1.0 for v in (-1, 0, 1)}
                for p, (vs, c) in zip(post, patterns):
                    count[vs[j]] += c * (p if truth else 1 - p)
                total = sum(count.values())
                share.append({v: x / total for v, x in count.items()})
            shares.append(share)
        new = []
        for vs, _ in patterns:
            odds = prior / (1 - prior)
            for j, v in enumerate(vs):
                odds *= shares[j][1][v] / shares[j][0][v]
            new.append(odds / (1 + odds))
        done = max((abs(a - b) for a, b in zip(post, new)), default=0) < 1e-6
        post = new
        if done:
            break
    return post, shares


def posteriors(counts: list[tuple[str, str, int]]) -> dict[tuple[str, str], float]:
    """Probability of personal data by (kind, votes), estimated for each kind by itself."""
    out = {}
    for kind in ADDED:
        own = [(v, n) for k, v, n in counts if k == kind]
        post, _ = expectation_maximisation([(tuple(map(int, v.split(","))), float(n)) for v, n in own])
        out |= {(kind, v): p for (v, _), p in zip(own, post)}
    return out


class Classifier:
    """Naive Bayes over the votes (as weighed by EM) and the context and shape of a span."""

    def __init__(self, post: dict[tuple[str, str], float], weights: dict[int, float]):
        self.odds = {k: math.log(min(max(p, 1e-6), 1 - 1e-6) / (1 - min(max(p, 1e-6), 1 - 1e-6))) for k, p in post.items()}
        self.weights = weights

    def probability(self, kind: str, vote: str, feature: list[int]) -> float:
        context = sum(self.weights.get(f, 0.0) for f in feature)
        return 1 / (1 + math.exp(-(self.odds.get((kind, vote), -CONTEXT) + max(-CONTEXT, min(CONTEXT, context)))))


_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.string()), ("votes", pa.string()), ("features", pa.list_(pa.int32()))])
_FOUND = "found array<struct<start: bigint, stop: bigint, kind: string, votes: string, features: array<int>>>"


def _all(text: str | None) -> list[dict]:
    """Base spans (no votes; features if they are like an added kind) and candidates of a text."""
    base = base_spans(text) if text else []
    out = []
    for s, e, k in base:
        like = LIKE.get(k)
        out.append({"start": s, "stop": e, "kind": k, "votes": None, "features": features(like, "", *_beside(text, s, e))[:-1] if like else None})
    return out + [{"start": s, "stop": e, "kind": k, "votes": v, "features": f} for s, e, k, (v, f) in (candidates(text, base) if text else ())]


def find(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and ``found``: base spans and candidates, with votes and features, of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "__text"):
            out = [_all(t) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, pa.list_(_SPAN))], [*keep, "found"])

    return arrow_map(docs.select(*[docs[k] for k in keep], docs[text].alias("__text")), run, schema_of(docs, keep, _FOUND))


def train(found: DataFrame) -> Classifier:
    """Classifier from the spans in ``found``.

    Only sums reach the driver: a row per kind and vote pattern, and one per
    feature, both bounded by the kinds, labelers and buckets.
    """
    spans = found.select(F.explode("found").alias("x")).select("x.*")
    counts = spans.where("votes IS NOT NULL").groupBy("kind", "votes").count().orderBy("kind", "votes")
    post = posteriors([tuple(r) for r in counts.collect()])
    if not post:
        return Classifier({}, {})
    table = F.broadcast(found.sparkSession.createDataFrame([(k, v, p) for (k, v), p in post.items()], "kind string, votes string, p double"))
    sure = spans.where("votes IS NULL AND features IS NOT NULL").select("features", F.lit(1.0).alias("p"))
    soft = spans.join(table, ["kind", "votes"]).select("features", "p").unionByName(sure)
    sums = soft.select(F.explode("features").alias("f"), "p").groupBy("f").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    whole: dict[tuple[int, int], list[float]] = {}
    part = lambda f: (f // _STRIDE, min(2, f % _STRIDE // BUCKETS))  # noqa: E731  kind and family of a feature
    for f, yes, no in sums:
        total = whole.setdefault(part(f), [0.0, 0.0])
        total[0] += yes
        total[1] += no
    weights = {}
    for f, yes, no in sums:
        a, b = whole[part(f)]
        weights[f] = math.log((yes + 1) / (a + 2)) - math.log((no + 1) / (b + 2))
    return Classifier(post, weights)


def detect(docs: DataFrame, keep: list[str], text: str = "text", limit: float = 0.5) -> DataFrame:
    """``keep`` and ``spans`` (``start``, ``stop``, ``kind``, ``base``), by start and kind, of every row.

    Offsets are code points, the end exclusive. A null or empty text has no
    spans, an empty table no rows; null keys, repeated keys and repeated rows are
    kept as they are; columns not in ``keep`` are dropped. Work and memory grow
    with the length of a text. The texts are read once; what is found in them is
    written to the shared folder.
    """
    found = staged(find(docs, keep, text), "pii")
    model = train(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for spans in b.column(b.num_columns - 1).to_pylist():
                kept = [x for x in spans if x["votes"] is None or model.probability(x["kind"], x["votes"], x["features"]) >= limit]
                out.append([{"start": x["start"], "stop": x["stop"], "kind": x["kind"], "base": x["votes"] is None}
                            for x in sorted(kept, key=lambda x: (x["start"], KINDS.index(x["kind"]), x["stop"]))])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, pa.list_(_KEPT))], [*keep, "spans"])

    return arrow_map(found, run, schema_of(docs, keep, "spans array<struct<start: bigint, stop: bigint, kind: string, base: boolean>>"))


_KEPT = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.string()), ("base", pa.bool_())])


def spell(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: float = 0.5) -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by ``[KIND]``; where spans overlap, the earlier one is named.

    All rows and columns stay; a null text stays null. Texts are read a second
    time, when the classifier is trained, which spares writing them beside what
    was found in them.
    """
    model = train(staged(find(docs, [], text), "pii"))
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            out = []
            for t in b.column(at).to_pylist():
                if t:
                    base = base_spans(t)
                    spans = sorted(base + [(s, e, k) for s, e, k, (v, f) in candidates(t, base) if model.probability(k, v, f) >= limit], key=lambda x: (x[0], KINDS.index(x[2])))
                    cut = [(0, 0, "")]
                    for s, e, k in spans:
                        if s >= cut[-1][1]:
                            cut.append((s, e, k))
                        elif e > cut[-1][1]:
                            cut[-1] = (cut[-1][0], e, cut[-1][2])
                    t = "".join(t[x[1]:y[0]] + f"[{y[2].upper()}]" * bool(y[2]) for x, y in pairwise([*cut, (len(t), len(t), "")]))
                out.append(t)
            yield pa.RecordBatch.from_arrays([c if i != at else pa.array(out, pa.string()) for i, c in enumerate(b.columns)], b.schema.names)

    return arrow_map(docs, run, docs.schema)
