"""Exact removal of repeated byte strings with a sparse enhanced suffix array.

Every string of ``length`` bytes (100) holds a k-gram of least hash, its anchor.
Equal strings have equal anchors at equal offsets, so only suffixes that start
at anchors are sorted, and only those whose anchor occurs more than once:

1. The anchors of each text are found with a sliding minimum over rolling
   hashes. An anchor stands for a run of neighbouring strings; its segment is
   the text that they cover.
2. Anchors are dealt by their hash, with a 64-bit hash of their segment; those
   that occur once are dropped. Of equal segments all but the earliest repeat it
   whole and go at once; only different segments of one anchor need their bytes.
3. Those segments are dealt by anchor and sorted by the bytes from the anchor
   on: the suffix array of one anchor's group. A stack scan over its
   common-prefix lengths yields the common-prefix intervals. In each interval
   the bytes before the anchor are scanned in the same way, and where they
   branch (left-extension diversity) the interval is a maximal repeat: a group
   with all its occurrences.
4. In a group all occurrences but the earliest go. Their spans are gathered by
   document and cut out.

A passage of a million copies thus costs a million rows of four numbers, which
are sorted and spilled by Spark, and one segment in the suffix array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, slices
from tessera.llm.minhash import mix

LENGTH, GRAM = 100, 24
_U64 = np.uint64
_BYTE = np.random.default_rng(77).integers(1, 2**64, 256, dtype=_U64)
_BASE = 0x9E3779B97F4A7C15
_SLOT = _U64((1 << 24) - 1)
#: A buffer has fewer positions than the low bits of a sort key can count.
BUFFER = 1 << 20


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the 24 bytes from each position on, built from those of 1, 2, 4, 8 and 16 bytes."""
    h, n = _BYTE[raw], 1
    while n < 16:
        eight = h if n == 8 else None
        h, n = h[:-n] * _U64(pow(_BASE, n, 2**64)) + h[n:], 2 * n
    return mix(h[:-8] * _U64(pow(_BASE, 8, 2**64)) + eight[16:16 + len(h) - 8])


class SpanHash:
    """64-bit hashes of spans of a buffer, from running sums."""

    def __init__(self):
        self.up = self.down = np.zeros(0, dtype=_U64)

    def __call__(self, raw: np.ndarray, start: np.ndarray, stop: np.ndarray, salt: np.ndarray) -> np.ndarray:
        if len(self.up) < len(raw):
            self.up, self.down = (np.full(len(raw), x, dtype=_U64) for x in (_BASE, pow(_BASE, -1, 2**64)))
            for x in (self.up, self.down):
                x[0] = 1
                np.multiply.accumulate(x, out=x)
        sums = np.concatenate((np.zeros(1, dtype=_U64), np.cumsum(_BYTE[raw] * self.up[:len(raw)], dtype=_U64)))
        return mix(mix((sums[stop] - sums[start]) * self.down[start]) + salt.astype(_U64))


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        v, n = np.minimum(v[:-n], v[n:]), 2 * n
    return np.minimum(v[:len(v) - (width - n)], v[width - n:])


def anchors(raw: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """``(key, anchor, first, last)`` of each run of strings in a buffer of texts that end at ``ends``.

    ``first`` and ``last`` are the first and last start of the strings that have
    this anchor. Among equal hashes the leftmost counts.
    """
    h = gram_hashes(raw)
    least = sliding_min((h & ~_SLOT) | np.arange(len(h), dtype=_U64), length - GRAM + 1)
    at = np.arange(len(least))
    inside = ends[np.searchsorted(ends, at, side="right")] - at >= length
    p, a = at[inside], (least[inside] & _SLOT).astype(np.int64)
    if not len(p):
        return p, p, p, p
    cut = np.flatnonzero(a[1:] != a[:-1]) + 1
    first, last = np.concatenate(([0], cut)), np.concatenate((cut - 1, [len(p) - 1]))
    return h[a[first]].view(np.int64), a[first], p[first], p[last]


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Buffers of whole texts: bytes, ends, rows, offsets. A text over the buffer is cut with an overlap."""
    held, rows, offs, size = [], [], [], 0

    def out():
        raw = np.frombuffer(b"".join(held), dtype=np.uint8)
        return raw, np.cumsum([len(x) for x in held]), np.array(rows), np.array(offs)

    for i, t in enumerate(texts):
        for lo in range(0, max(1, len(t) - length + 1), BUFFER):
            piece = t[lo:lo + BUFFER + length - 1]
            if len(piece) < length:
                continue
            held.append(piece), rows.append(i), offs.append(lo)
            size += len(piece)
            if size >= BUFFER:
                yield out()
                held, rows, offs, size = [], [], [], 0
    if held:
        yield out()


def _place(start, left, right):
    """Number of a place in its text: anchor, strings before and after it."""
    return (start << 14) | (left << 7) | right


def find_anchors(docs: DataFrame, length: int) -> DataFrame:
    """``key``, ``doc``, ``version``, ``place`` and ``seg`` (hash of the segment) of every anchor of the first copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = SpanHash()
        for b in slices(batches, "text", BUFFER):
            b = b.filter(pc.equal(b.column(2), 0))
            ids, versions = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 1))
            for raw, ends, rows, offs in _pieces(b.column(3).cast(pa.binary()).to_pylist(), length):
                key, a, first, last = anchors(raw, ends, length)
                if len(a):
                    k = np.searchsorted(ends, a, side="right")
                    start = a - np.concatenate(([0], ends))[k] + offs[k]
                    place = _place(start, a - first, a - last)
                    seg = spans(raw, first, last + length, place & (1 << 14) - 1).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, ids[rows[k]], versions[rows[k]], place, seg)], ["key", "doc", "version", "place", "seg"])

    return arrow_map(docs, run, "key bigint, doc bigint, version bigint, place bigint, seg bigint")


def _segments(docs: DataFrame, length: int) -> DataFrame:
    """The bytes of a segment from its anchor on and (reversed) before it, ``doc``, ``version`` and ``place``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 1 << 20):
            right, left, ids, versions, places = [], [], [], [], []
            for doc, version, copy, t, found in zip(*(c.to_pylist() for c in b.columns[:5])):
                if copy:
                    continue
                raw = t.encode()
                for place in found:
                    at, dl, dr = place >> 14, place >> 7 & 127, place & 127
                    ids.append(doc), versions.append(version), places.append(place)
                    right.append(raw[at:at - dr + length])
                    left.append(raw[at - dl:at][::-1])
            yield pa.RecordBatch.from_arrays([pa.array(right, pa.binary()), pa.array(left, pa.binary()), pa.array(ids, pa.int64()), pa.array(versions, pa.int64()),
                                              pa.array(places, pa.int64())], ["right", "left", "doc", "version", "place"])

    return arrow_map(docs, run, "right binary, left binary, doc bigint, version bigint, place bigint")


def common(x: bytes, y: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    lo = 0
    while n - lo > 1:
        mid = (lo + n) // 2
        if x[lo:mid] == y[lo:mid]:
            lo = mid
        else:
            n = mid
    return lo


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals ``(length, first, last)`` of an array, inner ones first.

    ``lcp[i]`` is the common prefix of suffixes ``i`` and ``i + 1``. One scan with
    a stack of open intervals.
    """
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > depth:
            inner, first = stack.pop()
            yield inner, first, i
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def maximal_repeats(group: list[tuple], length: int = LENGTH) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeats ``(before, after, members)`` of at least ``length`` bytes around one anchor.

    ``group``: different segments ``(right, left, doc, ...)`` in suffix-array
    order. ``members`` are all occurrences of the repeat.
    """
    reach = [len(s[1]) for s in group]
    for after, lo, hi in intervals([common(x[0], y[0]) for x, y in zip(group, group[1:])]):
        need = length - after
        inside = [i for i in range(lo, hi + 1) if reach[i] >= need]
        if len(inside) < 2:
            continue
        inside.sort(key=lambda i: group[i][1])
        lcs = [common(group[x][1], group[y][1]) for x, y in zip(inside, inside[1:])]
        if max(lcs) >= need:
            for before, first, last in intervals(lcs):
                if before >= need:  # the texts before it branch here
                    yield before, after, inside[first:last + 1]


def _removed(group: list[tuple], length: int) -> Iterator[tuple[int, int, int, int, int]]:
    """``(doc, version, place, before, after)``: how far around the anchor a segment repeats an earlier one."""
    if len(group) < 2:
        return
    before, after = [-1] * len(group), [0] * len(group)
    for left, right, members in maximal_repeats(group, length):
        earliest = min(members, key=lambda i: group[i][2:])
        for i in members:
            if i != earliest:
                before[i], after[i] = max(before[i], left), max(after[i], right)
    for s, left, right in zip(group, before, after):
        if left >= 0:
            yield *s[2:], left, right


def _span(start, stop):
    """Number of a span in its text: start, bytes."""
    return (start << 14) | (stop - start)


def repeated_spans(segments: DataFrame, length: int) -> DataFrame:
    """``doc``, ``version`` and ``span`` of text that repeats an earlier place, from different segments sorted by their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int, int, int]] = []
        group: list[tuple] = []
        gram = None

        def rows() -> pa.RecordBatch:
            doc, version, place, before, after = (np.array(x, dtype=np.int64) for x in zip(*out))
            at = place >> 14
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(version), pa.array(_span(at - before, at + after))], ["doc", "version", "span"])

        for b in batches:
            for s in zip(*(c.to_pylist() for c in b.columns)):
                if s[0][:GRAM] != gram:
                    out.extend(_removed(group, length))
                    group, gram = [], s[0][:GRAM]
                group.append(s)
                if len(out) >= 50_000:
                    yield rows()
        out.extend(_removed(group, length))
        if out:
            yield rows()

    return arrow_map(segments, run, "doc bigint, version bigint, span bigint")


def _shift(c: Column, bits: int) -> Column:
    return F.shiftleft(c.cast("bigint"), bits)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``key``, ``n_bytes``, ``n_removed``, ``spans`` (removed, maximal) and ``kept`` (the bytes left) of every row.

    A byte goes if a string of ``length`` bytes that covers it starts earlier
    too: in a smaller key, or before in the same text. Strings are judged on the
    input. A null text is empty. Rows that share a key count as documents behind
    each other, in the order of their texts' hashes (64 bits; rows with one key
    and one hash are copies of the first of them). A row with a null key has
    no place in the order: it is returned whole, and nothing is judged by it.
    Other columns are dropped. A text may have up to 2**36 bytes. An empty table
    gives no rows.
    """
    if not 2 * GRAM < length <= 127:
        raise ValueError("length must be between 49 and 127")
    base = docs.select(docs[key].cast("bigint").alias("doc"), F.coalesce(docs[text], F.lit("")).alias("text"))
    # a row is named by key and hash of its text: windows and joins by both deal a hot key over many tasks, and one shuffle of the texts serves all three uses
    alone = base.where("doc IS NULL").select("doc", F.lit(0).cast("bigint").alias("copy"), "text", *[F.lit(None).cast("array<bigint>").alias(c) for c in ("gone", "more", "open")])
    row = ["doc", "version"]
    base = base.where("doc IS NOT NULL").select("doc", F.xxhash64("text").alias("version"), "text")
    base = base.select(*row, (F.row_number().over(Window.partitionBy(*row).orderBy("version")) - 1).cast("bigint").alias("copy"), "text")
    # equal segments: the first stays in play, the others repeat it
    same, alike = Window.partitionBy("key", "seg").orderBy(*row, "place"), Window.partitionBy("key")
    found = (find_anchors(base, length).withColumn("nth", F.row_number().over(same))
             .withColumns({"least": F.min("seg").over(alike), "most": F.max("seg").over(alike)}).where("nth > 1 OR least < most"))
    at, dl, dr = (F.shiftright("place", 14), F.shiftright("place", 7).bitwiseAND(127), F.col("place").bitwiseAND(127))
    whole = _shift(at - dl, 14).bitwiseOR(dl - dr + length)
    marks = found.groupBy(*row).agg(F.collect_list(F.when(F.col("nth") == 1, F.col("place"))).alias("open"),
                                    F.collect_list(F.when(F.col("nth") > 1, whole)).alias("gone"))
    cut = _segments(base.join(marks.where(F.size("open") > 0), row).select(*row, "copy", "text", "open", "gone"), length)
    ordered = cut.repartition(F.substring("right", 1, GRAM)).sortWithinPartitions("right", "left", *row, "place")
    # both joins name the same columns of ``marks``, so one shuffle serves them
    spans = repeated_spans(ordered, length).groupBy(*row).agg(F.collect_list("span").alias("more"))
    judged = base.join(marks, row, "left").join(spans, row, "left").select("doc", "copy", "text", "gone", "more", "open").unionByName(alone)

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            size, removed, kept, runs = [], [], [], []
            for copy, t, gone, more in zip(*(b.column(c).to_pylist() for c in (1, 2, 3, 4))):
                raw, mine = t.encode(), []
                if copy:  # all its strings are in the row before
                    mine = [{"start": 0, "stop": len(raw)}] if len(raw) >= length else []
                for span in sorted((gone or []) + (more or [])) if not copy else ():
                    start = span >> 14
                    stop = start + (span & (1 << 14) - 1)
                    if mine and start <= mine[-1]["stop"]:
                        mine[-1]["stop"] = max(mine[-1]["stop"], stop)
                    else:
                        mine.append({"start": start, "stop": stop})
                edges = [0, *(e for m in mine for e in (m["start"], m["stop"])), len(raw)]
                kept.append(b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2])))
                size.append(len(raw)), removed.append(len(raw) - len(kept[-1])), runs.append(mine)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                                              pa.array(kept, pa.binary())], ["doc", "n_bytes", "n_removed", "spans", "kept"])

    out = arrow_map(judged, cut_out,
                    "doc bigint, n_bytes bigint, n_removed bigint, spans array<struct<start: bigint, stop: bigint>>, kept binary")
    return out.select(F.col("doc").cast(docs.schema[key].dataType).alias(key), "n_bytes", "n_removed", "spans", "kept")
