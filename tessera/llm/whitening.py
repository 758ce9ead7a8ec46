"""Principal components and whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows form a tall matrix ``A`` that no machine holds. Its leading
right singular vectors are the components, its singular values over ``sqrt(n)``
the deviations along them.

* Rows are written once as blocks of long integers. Integer sums centre them:
  ``(n x - S) / n`` rounds once, however far the data lie from the origin.
* Each Lanczos step is one pass over the blocks. A block forms its rows of
  ``A w`` and adds their products back, ``A' (A w)``; sums of as many numbers as
  a vector has entries reach the driver, grouped by entry.
* A left vector is as long as the table. It is kept as ``u = A p`` by its short
  ``p``, so products with all earlier left vectors are ``P' (A' u)``: both sides
  are reorthogonalised in full, twice, without another pass.
* If the space is exhausted (equal deviations, dependent columns), the next step
  starts from a fresh direction orthogonal to all before.
* The small bidiagonal matrix is decomposed on the driver. A pass of all found
  components together then rotates them (Rayleigh-Ritz), which takes out what
  rounding is left.

A step needs the one before, so the steps follow each other; their number is at
most the length of a vector, whatever the number of rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, schema_of, staged

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Rows of a block.
BLOCK = 2048
#: Entries as large as this would leave the exact range; such a row counts as not finite.
LIMIT = float(1 << 40)
#: A direction of less than this share of the whole variance counts as none.
TINY = 1e-14


def usable(vec: str | Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    v = F.col(vec) if isinstance(vec, str) else vec
    return v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: F.coalesce(F.abs(c.cast("double")) < LIMIT, F.lit(False)))


def grid(vec: str) -> Column:
    """Entries as long integers: ``floor(SCALE * c) + OFFSET``."""
    return F.transform(vec, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + OFFSET)


def blocks(df: DataFrame, key: str, vec: str, width: int) -> DataFrame:
    """``(keys, rows)``: up to ``BLOCK`` keys and their integers, packed row by row."""
    rows = df.where(usable(vec) & (F.size(vec) == width)).select(F.col(key).alias("key"), grid(vec).alias("x"))
    kind = rows.schema["key"].dataType.simpleString()

    def pack(batches):
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                x = part.column(1).flatten().to_numpy()
                keys = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
                yield pa.RecordBatch.from_arrays([keys, pa.array([x.tobytes()], pa.binary())], ["keys", "rows"])

    return arrow_map(rows, pack, f"keys array<{kind}>, rows binary")


def _each(batches):
    for b in batches:
        for raw in b.column(b.schema.get_field_index("rows")):
            yield np.frombuffer(raw.as_buffer(), dtype="<i8")


def totals(held: DataFrame, width: int, of) -> np.ndarray:
    """Sum over all blocks of an array that ``of`` makes of a block's rows; of a fixed length, whatever the table."""

    def run(batches):
        got = None
        for raw in _each(batches):
            part = of(raw.reshape(-1, width))
            got = part if got is None else got + part
        if got is not None:
            flat = got.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["i", "v"])

    kind = "bigint" if of(np.zeros((1, width), np.int64)).dtype == np.int64 else "double"
    got = arrow_map(held.select("rows"), run, f"i int, v {kind}").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(len(got), np.int64 if kind == "bigint" else np.float64)
    for i, v in got:
        out[i] = v
    return out


def centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """Rows less their mean, rounded once."""
    return (x * n - total) / n


def _orthogonal(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """``v`` less its parts along an orthonormal basis, in two sweeps."""
    if basis:
        b = np.array(basis)
        for _ in range(2):
            v = v - b.T @ (b @ v)
    return v


def _fresh(basis: list[np.ndarray], width: int, rng) -> np.ndarray:
    v = _orthogonal(rng.standard_normal(width), basis)
    return v / np.linalg.norm(v)


def bidiagonalise(back, width: int, variance: float, wanted: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """``(values, vectors)``: squared singular values, falling, and right singular vectors as columns.

    ``back(w)`` gives ``A' (A w)``; ``variance`` is the sum of all squared
    singular values. Steps end when the vectors span the whole space, when what
    is left of the variance is nothing, or when the wanted vectors have settled
    and no vector that is still hidden could come before them.
    """
    rng = np.random.default_rng(seed)
    right, left, image, columns = [], [], [], []  # v; p with u = A p; A'u; coordinates of A v along the u
    v, floor = _fresh(right, width, rng), TINY * variance
    while True:
        right.append(v)
        product = back(v)
        along, w, g = np.zeros(len(left)), v, product
        for _ in range(2 if left else 0):  # u = A v less its parts along the earlier u
            more = np.array(left) @ g
            along, w, g = along + more, w - np.array(left).T @ more, g - np.array(image).T @ more
        size2 = float(w @ g)
        columns.append(along)
        after = None
        if size2 > floor:
            alpha = np.sqrt(size2)
            columns[-1] = np.append(along, alpha)
            left.append(w / alpha)
            image.append(g / alpha)
            after = _orthogonal(image[-1], right)
        b = np.zeros((max(1, len(left)), len(right)))
        for i, c in enumerate(columns):
            b[:len(c), i] = c
        ends, s, vt = np.linalg.svd(b)  # all of vt: directions without variance complete the space
        found = s * s
        rest = variance - found.sum()
        beta = 0.0 if after is None else float(np.linalg.norm(after))
        if len(right) == width or rest <= 1e-14 * variance:
            break
        if len(s) > wanted and rest < found[wanted - 1] and beta * np.abs(ends[-1, :wanted]).max() <= 1e-14 * s[0]:
            break
        v = after / beta if beta > 1e-13 * np.sqrt(variance) else _fresh(right, width, rng)
        v = _orthogonal(v, right)
        v = v / np.linalg.norm(v)
    return np.append(found, np.zeros(len(right) - len(found))), np.array(right).T @ vt.T


def components(held: DataFrame, width: int, wanted: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, float]:
    """``(n, sums, variances, vectors, trace)`` of the rows in ``held``, at most ``wanted`` of positive variance."""
    first = totals(held, width, lambda x: np.append(x.sum(axis=0), len(x)))
    if not len(first) or not first[-1]:
        return 0, np.zeros(width, np.int64), np.zeros(0), np.zeros((width, 0)), 0.0
    n, total = int(first[-1]), first[:-1]
    whole = float(totals(held, width, lambda x: (centred(x, n, total) ** 2).sum(axis=0)).sum())
    if whole <= 0:
        return n, total, np.zeros(0), np.zeros((width, 0)), 0.0

    def back(w: np.ndarray) -> np.ndarray:
        def of(x):
            a = centred(x, n, total)
            return a.T @ (a @ w)
        return totals(held, width, of).reshape(w.shape)

    _, vectors = bidiagonalise(back, width, whole, wanted)
    vectors = np.linalg.qr(vectors)[0]
    values, turn = np.linalg.eigh((lambda h: (h + h.T) / 2)(vectors.T @ back(vectors)))
    order = [i for i in np.argsort(-values, kind="stable")[:wanted] if values[i] > 1e-13 * whole]
    vectors = vectors @ turn[:, order]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0)
    return n, total, values[order] / n, vectors, whole / n


def deviations(x: np.ndarray, n: int, total: np.ndarray) -> list[int | None]:
    """Squared distances of ``n x`` from the sums, exact; null beyond 64 bits."""
    d = x * n - total
    if float(np.abs(d).max(initial=0)) ** 2 * d.shape[1] < 2.0 ** 62:
        return (d * d).sum(axis=1).tolist()
    sums = [sum(int(v) ** 2 for v in row) for row in d]
    return [s if s < 1 << 63 else None for s in sums]


def whiten(df: DataFrame, key: str = "vec_id", vec: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates of every usable row, one row per component.

    Returns ``key``, ``component`` (from 1, by falling variance), ``n``,
    ``deviation``, ``whitened``, ``explained`` and ``identity_error`` (largest
    absolute entry of the covariance of ``whitened`` minus the identity, over all
    rows). A component's sign makes its largest entry positive.

    Rows whose vector is null, empty or holds a null, non-finite or absurdly
    large entry (``LIMIT``) are left out, as are vectors of another length than
    most have (of ties, the longer). Repeated rows and keys count as often as
    they stand there; keys may be null. Directions without variance have no
    whitened form and give no component, so a table of equal vectors gives no
    rows, nor does an empty one. ``deviation`` is null where 64 bits cannot hold
    it. Other columns, whatever their names, are ignored.
    """
    spark = df.sparkSession
    schema = (schema_of(df, [key], "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"))
    lengths = df.where(usable(vec)).groupBy(F.size(vec).alias("w")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("w")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    width = lengths["w"]
    held = staged(blocks(df, key, vec, width), "whitening-blocks")
    n, total, variances, vectors, trace = components(held, width, wanted)
    m = len(variances)
    if not m:
        return spark.createDataFrame([], schema)
    project = vectors / np.sqrt(variances)

    def moments(x):
        z = centred(x, n, total) @ project
        return np.append((z.T @ z).ravel(), z.sum(axis=0))

    sums = totals(held, width, moments) / n
    error = float(np.abs(sums[:-m].reshape(m, m) - np.outer(sums[-m:], sums[-m:]) - np.eye(m)).max())
    names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def spread(batches):
        for b in batches:
            for keys, raw in zip(b.column(0), _each([b])):
                x = raw.reshape(-1, width)
                z = centred(x, n, total) @ project
                rows = np.repeat(np.arange(len(x)), m)
                yield pa.RecordBatch.from_arrays([
                    keys.values.take(pa.array(rows)), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(rows), n, np.int64)), pa.array(deviations(x, n, total), pa.int64()).take(pa.array(rows)),
                    pa.array(z.ravel()), pa.array(np.tile(variances / trace, len(x))), pa.array(np.full(len(rows), error))], names)

    return arrow_map(held, spread, schema)
