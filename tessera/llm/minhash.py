"""Near-duplicate documents: MinHash bands, odd sketches and full sets.

1. Each text becomes the set of its word shingles (64-bit hashes). 96 MinHash
   samples by as many permutations give 24 band keys of 4 rows. The least hashes
   of 16384 bins, samples by one permutation, give an odd sketch: each flips one
   bit of a 2048-bit map.
2. Texts with equal sets are one class. Class members are never paired.
3. Classes that share a band key and are near enough in size are candidates. The
   population count of the XOR of two odd sketches estimates how many samples
   differ, much more sharply than the bands at high similarity; only pairs that
   may reach the limit go on.
4. The pairs that remain are confirmed on the full sets, and connected
   components are found with large-star and small-star steps.

In a band bucket the members are first compared with its hub, the member that
meets most others in all its buckets: the original of a group of edited copies
is the hub of all of them. Pairs of the others are compared only where they are
still in different components, so a group of thousands of near copies costs a
star, not a square.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, slices, staged

BANDS, ROWS = 24, 4
SAMPLES = BANDS * ROWS
BIN_BITS = 14
BINS = 1 << BIN_BITS
SKETCH_BITS = 2048
BLOCK = 1 << 17
_U64 = np.uint64
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**64, 256, dtype=_U64)
_MULT = (_rng.integers(0, 2**32, SAMPLES, dtype=np.uint32) | np.uint32(1))[:, None]
_MASK = _rng.integers(0, 2**32, SAMPLES, dtype=np.uint32)[:, None]
_BASE = _U64(0x9E3779B97F4A7C15)
_INV = _U64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = (x ^ (x >> _U64(33))) * _U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U64(33))) * _U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U64(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=_U64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


class Shingler:
    """Hashes of the distinct word shingles of UTF-8 texts, a buffer of texts at a time."""

    def __init__(self, size: int):
        self.size = size
        self.up = self.down = np.zeros(0, dtype=_U64)

    def words(self, raw: np.ndarray) -> np.ndarray:
        """Hash of each word of a text (lower-cased A-Z), in order.

        Whole words are hashed a block at a time, so that the working arrays,
        of many bytes a character, grow with a block and not with the text.
        """
        gap = _SPACE[raw]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True]))))
        starts, ends = edge[::2], edge[1::2]
        out = np.empty(len(starts), dtype=_U64)
        lo = 0
        while lo < len(starts):
            hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + BLOCK, side="right")))
            s, e = starts[lo:hi] - starts[lo], ends[lo:hi] - starts[lo]
            block = raw[starts[lo]:ends[hi - 1]]
            if len(self.up) <= len(block):
                n = max(BLOCK, len(block)) + 1
                self.up, self.down = _powers(_BASE, n), _powers(_INV, n)
            sums = np.zeros(len(block) + 1, dtype=_U64)
            np.cumsum(_BYTE[_LOWER[block]] * self.up[:len(block)], out=sums[1:])
            out[lo:hi] = mix((sums[e] - sums[s]) * self.down[s] + (e - s).astype(_U64))
            lo = hi
        return out

    def shingles(self, text: bytes) -> np.ndarray:
        """Sorted distinct shingle hashes; a shorter text is one shingle, a text without words none."""
        w = self.words(np.frombuffer(text, dtype=np.uint8))
        if not len(w):
            return w
        n = min(self.size, len(w))
        h = np.full(len(w) - n + 1, n, dtype=_U64)
        for k in range(n):
            h = mix(h * _BASE + w[k:len(w) - n + k + 1])
        return np.unique(h)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """The samples of a set: for each of ``SAMPLES`` permutations the least image."""
    low = shingles.astype(np.uint32)
    out = np.full(SAMPLES, 2**32 - 1, dtype=np.uint32)
    for lo in range(0, len(low), 4096):
        part = (low[lo:lo + 4096][None, :] ^ _MASK) * _MULT
        part ^= part >> np.uint32(15)
        np.minimum(out, part.min(axis=1), out=out)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDS, dtype=_U64)
    for r in samples.reshape(BANDS, ROWS).T:
        keys = mix(keys * _BASE + r)
    return keys.astype(np.int64)


def odd_sketch(shingles: np.ndarray) -> bytes:
    """Parity bitmap of the least hash of each bin; ``shingles`` are sorted, and their high bits name the bins."""
    bins = shingles >> _U64(64 - BIN_BITS)
    least = shingles[np.concatenate(([True], bins[1:] != bins[:-1]))]
    flips = np.bincount((mix(least) % _U64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS)
    return np.packbits((flips & 1).astype(np.uint8)).tobytes()


def _poisson_bound(mean: np.ndarray, sigmas: float, tail: float = 3e-7) -> np.ndarray:
    """A number that a Poisson variable exceeds with a probability of about ``tail`` at most."""
    out = mean + sigmas * np.sqrt(mean) + 4
    for q, factorial in ((3, 24), (2, 6), (1, 2), (0, 1)):
        out = np.where(mean ** (q + 1) / factorial < tail, q, out)
    return out


def odd_limit(m: np.ndarray, n: np.ndarray, jaccard: float, sigmas: float = 5.0) -> np.ndarray:
    """Largest XOR population count that sets of ``m`` and ``n`` shingles of at least this similarity plausibly have.

    The sizes give how many shingles differ. In thin bins each flips one bit,
    and one more if it shares its bin (a Poisson number, bounded by its tail);
    in full bins a binomial number of bins differ, by two flips each, and lies
    within ``sigmas`` standard deviations. The lower bound counts. Flips of one
    bit cancel: the count of odd bits is bounded by the flips and, with its
    exact variance, above its mean.
    """
    union = (m + n) / (1 + jaccard)
    differ = union * (1 - jaccard)
    crowded = 1 - np.exp(-union / BINS)
    thin = differ + _poisson_bound(differ * crowded, sigmas)
    bins = np.minimum(union, BINS)
    full = 2 * (bins * (1 - jaccard) + sigmas * np.sqrt(bins * jaccard * (1 - jaccard)))
    flips = np.minimum(thin, full)
    even = (1 - 2 / SKETCH_BITS) ** flips
    variance = (SKETCH_BITS + SKETCH_BITS * (SKETCH_BITS - 1) * (1 - 4 / SKETCH_BITS) ** flips - (SKETCH_BITS * even) ** 2) / 4
    return np.ceil(np.minimum(flips, SKETCH_BITS * (1 - even) / 2 + sigmas * np.sqrt(np.maximum(variance, 0))))


def plausible(m: np.ndarray, x: np.ndarray, n: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of sizes ``m``, ``n`` and odd sketches ``x``, ``y`` may have the similarity."""
    sized = 100 * np.minimum(m, n) >= percent * np.maximum(m, n)  # exact: no pair beyond it can reach the limit
    return sized & (popcount(x, y) <= odd_limit(m, n, percent / 100))


def sketches(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``id``, ``n`` (size of the shingle set), ``cls`` (hash of the set), ``bands`` and ``odd`` of every row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Shingler(size)
        for b in slices(batches, "text"):
            ns, cls, bands, odd = [], [], [], []
            for t in b.column(1).cast(pa.binary()).to_pylist():
                s = make.shingles(t or b"")
                ns.append(len(s))
                if not len(s):
                    cls.append(None), bands.append(None), odd.append(None)
                    continue
                m = minhash(s)
                # 128 bits over the whole set: equal sets, equal classes
                cls.append(_digest(s))
                bands.append(band_keys(m)), odd.append(odd_sketch(s))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ns, pa.int64()), pa.array(cls, pa.binary()),
                                              pa.array(bands, pa.list_(pa.int64())), pa.array(odd, pa.binary())], ["id", "n", "cls", "bands", "odd"])

    return arrow_map(docs.select(docs[key].alias("id"), docs[text].alias("text")), run,
                     f"id {kind}, n bigint, cls binary, bands array<bigint>, odd binary")


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def popcount(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Groups of rows with one value in the first column, from rows sorted by it; a group may span batches."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        k = b.column(0).to_numpy(zero_copy_only=False)
        if not len(k):
            continue
        cuts = np.concatenate(([0], np.flatnonzero(k[1:] != k[:-1]) + 1, [len(k)]))
        if held and held[0].column(0)[0].as_py() != k[0]:
            yield held
            held = []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if lo:
                yield held
                held = []
            held = [*held, b.slice(lo, hi - lo)]
    if held:
        yield held


def _cross(buckets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a < b`` of one bucket in different components whose odd sketches may be near.

    ``buckets``: key, component, id, size, odd sketch and all keys of a member.
    A pair is given out in the first bucket that it shares. Sketches are compared in
    blocks, each member with those of other components behind it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _members(batches):
            comp = np.concatenate([g.column(1).to_numpy(zero_copy_only=False) for g in group])
            if len(comp) < 2 or (comp == comp[0]).all():
                continue
            ids = np.concatenate([g.column(2).to_numpy(zero_copy_only=False) for g in group])
            n = np.concatenate([g.column(3).to_numpy(zero_copy_only=False) for g in group])
            odd = np.frombuffer(b"".join(x for g in group for x in g.column(4).to_pylist()), dtype=np.uint64).reshape(len(ids), -1)
            bands = np.concatenate([g.column(5).flatten().to_numpy(zero_copy_only=False) for g in group]).reshape(len(ids), BANDS)
            key = group[0].column(0)[0].as_py()
            order = np.argsort(comp, kind="stable")  # a component's members stand together
            comp, ids, n, odd, bands = comp[order], ids[order], n[order], odd[order], bands[order]
            after = np.searchsorted(comp, comp, side="right")
            left, right, held = [], [], 0
            for i in range(len(ids)):
                for lo in range(after[i], len(ids), 65536):
                    near = lo + np.flatnonzero(plausible(n[i], odd[i], n[lo:lo + 65536], odd[lo:lo + 65536], percent))
                    first = (bands[near] == bands[i]).argmax(axis=1)
                    near = near[bands[i][first] == key]
                    left.append(np.minimum(ids[i], ids[near])), right.append(np.maximum(ids[i], ids[near]))
                    held += len(near)
                if held > 50_000 or i == len(ids) - 1:
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], ["a", "b"])
                    left, right, held = [], [], 0

    return arrow_map(buckets, run, "a bigint, b bigint")


def _confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the distinct pairs whose full sets have ``100 * intersection >= percent * union``."""
    ship = staged(pairs.distinct(), "minhash-pairs")
    used = ship.select(F.explode(F.array("a", "b")).alias("id")).distinct()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Shingler(size)
        for b in slices(batches, "text"):
            got = [make.shingles(t or b"").tobytes() for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.binary())], ["id", "set"])

    full = staged(arrow_map(texts.join(used, "id", "left_semi").select("id", "text"), sets, "id bigint, set binary"), "minhash-sets")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for i, (x, y) in enumerate(zip(b.column(2), b.column(3))):
                x, y = np.frombuffer(x.as_py(), _U64), np.frombuffer(y.as_py(), _U64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([b.column(c).take(pa.array(keep, pa.int64())) for c in (0, 1)], ["a", "b"])

    # b first: a hub is the ``a`` of many pairs, and its set then stays on the other side of the shuffle
    both = (ship.join(full.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
            .join(full.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a").select("a", "b", "sa", "sb"))
    return staged(arrow_map(both, near, "a bigint, b bigint"), "minhash-links")


def components(edges: DataFrame) -> DataFrame:
    """``id``, ``comp`` (least id reachable) of every end of an edge ``a``, ``b``.

    Large-star and small-star steps until nothing changes; each round is
    written to the shared folder, so its plan stays short.
    """
    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "components")
    was, now = None, state(e)
    while now != was:
        both = e.union(e.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours all point to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        e = staged(small.distinct(), "components")
        was, now = now, state(e)
    return e.select(F.col("u").alias("id"), F.col("v").alias("comp"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Documents whose sets of ``size``-word shingles have a Jaccard similarity of
    at least ``percent`` hundredths are linked; ``component_id`` is the least
    key reachable and ``kept`` marks it. A pair at the limit escapes all bands
    with probability ``(1 - (percent / 100) ** 4) ** 24`` (3e-6 at 0.8).

    A text that is null or has no word has no shingles and no links. Rows with
    one key are one document when their texts are equal, linked or not as their
    texts say otherwise. A row with a null key takes part in no link, is its own
    component (null) and is kept. Other columns are dropped. An empty table gives
    no rows; the words of a very long text are hashed in blocks.
    """
    base = docs.select(docs[key].cast("bigint").alias("id"), docs[text].alias("text"))
    sketch = staged(sketches(base, "id", "text", size), "minhash-sketch")
    known = sketch.where("id IS NOT NULL AND cls IS NOT NULL")
    # one row per set: the class, named by its least id; partial sums absorb hot classes
    first = known.groupBy("cls").agg(F.min(F.struct("id", "n", "bands", "odd")).alias("r")).select("cls", "r.*")
    classes = staged(first, "minhash-classes")
    odd = classes.select("id", "n", "odd")
    buckets = classes.select(F.explode("bands").alias("band"), "id")
    met = buckets.groupBy("band").agg(F.count("*").alias("m")).where("m > 1")
    shared = staged(buckets.join(met, "band"), "minhash-buckets")
    # star: every member of a bucket with its hub
    rank = shared.groupBy("id").agg(F.sum("m").alias("rank"))
    hubs = shared.join(rank, "id").groupBy("band").agg(F.min(F.struct((-F.col("rank")).alias("rank"), "id")).alias("hub")).select("band", F.col("hub.id").alias("a"))
    star = shared.join(hubs, "band").where("id <> a").select("a", F.col("id").alias("b")).distinct()
    star = (star.join(odd.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("odd").alias("ob")), "b")
            .join(odd.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("odd").alias("oa")), "a").select("a", "b", "na", "nb", "oa", "ob"))

    def sharp(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m, n = (b.column(c).to_numpy(zero_copy_only=False) for c in (2, 3))
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), dtype=_U64).reshape(b.num_rows, SKETCH_BITS // 64) for c in (4, 5))
            yield b.select(["a", "b"]).filter(pa.array(plausible(m, x, n, y, percent)))

    texts = base.where("id IS NOT NULL")
    links = _confirm(arrow_map(star, sharp, "a bigint, b bigint").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), texts, size, percent)
    comp = components(links)
    # the rest: members of one bucket that are still apart
    rest = shared.join(comp, "id", "left").select("band", F.coalesce("comp", "id").alias("comp"), "id")
    apart = rest.groupBy("band").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("band")
    grouped = rest.join(apart, "band", "left_semi").join(classes.select("id", "n", "odd", "bands"), "id").repartition("band")
    grouped = grouped.sortWithinPartitions("band").select("band", "comp", "id", "n", "odd", "bands")
    more = _confirm(_cross(grouped, percent), texts, size, percent)
    final = components(comp.select(F.col("id").alias("a"), F.col("comp").alias("b")).union(more.select("a", "b")))
    named = classes.select("cls", "id").join(final, "id", "left").select("cls", F.coalesce("comp", "id").alias("component_id"))
    out = sketch.drop("bands", "odd").join(named, "cls", "left")
    comp_id = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    kind = docs.schema[key].dataType
    return out.select(F.col("id").cast(kind).alias(key), F.col("n").alias("n_shingles"), comp_id.cast(kind).alias("component_id"),
                      (F.col("id").isNull() | (F.col("id") == comp_id)).alias("kept"))
