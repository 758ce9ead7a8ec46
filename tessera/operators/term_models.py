"""Text features and models on long term counts.

A vocabulary is a table ``(term, idx)``, dense in term order; a feature vector is
an aggregation of ``(id, idx, value)`` rows; parameters of a model are tables with
a row per term. Nothing that has a row per term or per document is ever on the
driver, so vocabularies are never cut for its sake.

``counts`` is a table ``(id, term, tf)`` with a row per document and term
(``text.counts_on_vocabulary``).
"""

from __future__ import annotations

import zlib
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pac
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import HASH_SPACE, portable_hash_of
from tessera.functions.ordering import dense_index
from tessera.functions.staging import stage
from tessera.functions.subquery import attach_row


# ---- sparse vectors ------------------------------------------------------------


def numbered_vocabulary(vocab: DataFrame) -> DataFrame:
    """``vocab`` with ``idx``, dense from 0 in the order of ``term``."""
    return dense_index(vocab, ["term"], "idx")


def weighted_terms(counts: DataFrame, vocab: DataFrame, docs: DataFrame, id_col: str) -> DataFrame:
    """``(id, idx, value)``: tf * ln((N + 1) / (df + 1)), with ``df`` of the vocabulary and N rows of ``docs``."""
    n = docs.agg(F.count(F.lit(1)).alias("__n"))  # one row
    idf = attach_row(vocab.select("term", "idx", "df"), n).select("term", "idx", F.log((F.col("__n") + 1) / (F.col("df") + 1)).alias("__idf"))
    return counts.join(idf, "term").select(id_col, "idx", (F.col("tf") * F.col("__idf")).alias("value"))


def assemble_sparse(cells: DataFrame, docs: DataFrame, id_col: str, width: int, numeric: list[str]) -> DataFrame:
    """``(id, size, indices, values)`` of every row of ``docs``: its cells, then its ``numeric`` columns.

    Zeros are left out. A document without cells has its numeric columns alone;
    null numbers count as zero.
    """
    own = cells.where(F.col("value") != 0).groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("idx", "value"))).alias("__c"))  # one document's terms
    cell = "struct<idx:bigint,value:double>"
    extra = F.array(*[F.struct(F.lit(width + i).cast("bigint").alias("idx"), F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias("value")) for i, c in enumerate(numeric)])
    out = docs.select(id_col, extra.cast(f"array<{cell}>").alias("__x")).join(own, id_col, "left")
    every = F.concat(F.coalesce(F.col("__c").cast(f"array<{cell}>"), F.array().cast(f"array<{cell}>")), F.filter("__x", lambda s: s["value"] != 0))
    return out.select(id_col, F.lit(width + len(numeric)).alias("size"), every.alias("__a")).select(
        id_col, "size", F.col("__a.idx").alias("indices"), F.col("__a.value").alias("values"))


# ---- naive Bayes ---------------------------------------------------------------


def class_priors(labels: DataFrame, label: str) -> DataFrame:
    """``(label, prior)``: log share of each class."""
    c = labels.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    return attach_row(c, c.agg(F.sum("__n").alias("__all"))).select(label, F.log(F.col("__n") / F.col("__all")).alias("prior"))


def multinomial_fit(counts: DataFrame, vocab: DataFrame, labels: DataFrame, id_col: str, label: str, smoothing: float) -> tuple[DataFrame, DataFrame]:
    """``(classes, terms)`` of a multinomial naive Bayes model.

    ``classes`` is ``(label, prior, absent)``, ``absent`` the log probability of
    a term the class does not hold; ``terms`` is ``(label, term, gain)``, what a
    term that it holds adds to that.
    """
    held = counts.join(labels.select(id_col, label), id_col).groupBy(label, "term").agg(F.sum("tf").alias("__c"))
    held = stage(held, "bayes-terms")
    size = vocab.agg(F.count(F.lit(1)).alias("__v"))
    total = class_priors(labels, label).join(held.groupBy(label).agg(F.sum("__c").alias("__t")), label, "left")
    total = attach_row(total, size).withColumn("absent", F.log(F.lit(smoothing) / (F.coalesce("__t", F.lit(0)) + F.lit(smoothing) * F.col("__v"))))
    classes = stage(total.select(label, "prior", "absent"), "bayes-classes")
    return classes, held.select(label, "term", F.log((F.col("__c") + F.lit(smoothing)) / F.lit(smoothing)).alias("gain"))


def multinomial_scores(counts: DataFrame, docs: DataFrame, model: tuple[DataFrame, DataFrame], id_col: str, label: str) -> DataFrame:
    """``(id, label, score)``: joint log probability of each document of ``docs`` and class."""
    classes, terms = model
    length = counts.groupBy(id_col).agg(F.sum("tf").alias("__n"))
    gains = counts.join(terms, "term").groupBy(id_col, label).agg(F.sum(F.col("tf") * F.col("gain")).alias("__g"))
    every = F.array_sort(F.collect_list(F.struct(F.col(label), "prior", "absent")))  # a row per class
    rows = attach_row(docs.select(id_col).join(length, id_col, "left"), classes.agg(every.alias("__m")))
    rows = rows.select(id_col, "__n", F.inline("__m")).join(gains, [id_col, label], "left")
    return rows.select(id_col, label, (F.col("prior") + F.coalesce("__n", F.lit(0)) * F.col("absent") + F.coalesce("__g", F.lit(0.0))).alias("score"))


def gaussian_fit(train: DataFrame, features: list[str], label: str, smoothing: float = 1e-9) -> DataFrame:
    """``(label, prior, m_*, v_*)``: mean and population variance per class, plus ``smoothing`` times the largest variance of all rows."""
    widest = train.agg(F.array_max(F.array(*[F.var_pop(c) for c in features])).alias("__e"))
    per = train.groupBy(label).agg(*[F.avg(c).alias(f"m_{c}") for c in features], *[F.var_pop(c).alias(f"__v_{c}") for c in features])
    per = attach_row(per, widest).withColumns({f"v_{c}": F.col(f"__v_{c}") + F.lit(smoothing) * F.col("__e") for c in features})
    return stage(per.join(class_priors(train, label), label).select(label, "prior", *[f"{p}_{c}" for p in "mv" for c in features]), "bayes-gaussian")


def gaussian_scores(df: DataFrame, model: DataFrame, features: list[str], id_col: str, label: str) -> DataFrame:
    """``(id, label, score)``: joint log density of each row and class."""
    every = F.array_sort(F.collect_list(F.struct(F.col(label).alias("__label"), *[c for c in model.columns if c != label])))  # a row per class
    rows = attach_row(df.select(id_col, *features), model.agg(every.alias("__m"))).select(id_col, *features, F.inline("__m"))
    score = F.col("prior")
    for c in features:
        score = score - F.log(2 * F.pi() * F.col(f"v_{c}")) / 2 - F.pow(F.col(c) - F.col(f"m_{c}"), 2) / (2 * F.col(f"v_{c}"))
    return rows.select(id_col, F.col("__label").alias(label), score.alias("score"))


def best_class(scores: DataFrame, id_col: str, label: str) -> DataFrame:
    """``(id, prediction)``: the class of largest score, ties to the smallest."""
    return scores.groupBy(id_col).agg(F.min_by(label, F.struct((-F.col("score")).alias("s"), F.col(label).alias("l"))).alias("prediction"))


def margin(scores: DataFrame, id_col: str, label: str, positive) -> DataFrame:
    """``(id, margin)``: score of the positive class less that of the other."""
    yes = F.col(label) == F.lit(positive)
    return scores.groupBy(id_col).agg((F.max(F.when(yes, F.col("score"))) - F.max(F.when(~yes, F.col("score")))).alias("margin"))


# ---- topics --------------------------------------------------------------------


#: Rows of a block of documents, as counted; a task holds one block.
LDA_BLOCK = 4_000_000
#: Terms fall into so many buckets by hash; a shard is a run of buckets. Places of terms in blocks that a shard holds.
LDA_BUCKETS, LDA_SHARD = 4096, 1_000_000
#: Rows that the numbers of a step are computed for at a time.
_PART = 1 << 18
_OUT = "__shard int, __block bigint, docs boolean, value binary, whole binary"


def _shares(prefix: str, k: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(k)]


def _column(table: pa.Table, name: str) -> pa.Array:
    return table.column(name).combine_chunks()


def _small(tf: np.ndarray) -> np.ndarray:
    """``tf`` in the least unsigned type that holds it, or as numbers with a fraction."""
    if tf.dtype.kind in "iu" and (not len(tf) or tf.min() >= 0):
        return tf.astype(np.min_scalar_type(int(tf.max()) if len(tf) else 0))
    return tf.astype(np.float64)


def _packed(table: pa.Table, id_col: str, block: int) -> pa.RecordBatch:
    """One block as a row of numbers: its documents, their lengths, and place of the term and tf of each count; its terms by bucket."""
    ids, terms = _column(table, id_col).dictionary_encode(), _column(table, "term").dictionary_encode()
    bucket = np.array([zlib.crc32(w.encode()) % LDA_BUCKETS for w in terms.dictionary.to_pylist()], np.uint16)
    by_term = pac.sort_indices(terms.dictionary).to_numpy()
    order = by_term[np.argsort(bucket[by_term], kind="stable")]
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    tf = _small(_column(table, "tf").to_numpy(zero_copy_only=False))
    one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
    raw = lambda a: pa.array([a.tobytes()], pa.binary())
    cells = {"__block": pa.array([block], pa.int64()), "n_terms": pa.array([len(order)], pa.int64()), "ids": one(ids.dictionary),
             "lengths": raw(np.bincount(ids.indices.to_numpy(), minlength=len(ids.dictionary)).astype(np.int32)),
             "places": raw(place[terms.indices.to_numpy()]), "tf": raw(tf), "tf_type": pa.array([tf.dtype.str]),
             "terms": one(terms.dictionary.take(pa.array(order))), "buckets": raw(bucket[order])}
    return pa.RecordBatch.from_pydict(cells)


class Blocks(NamedTuple):
    """Documents as blocks of numbers, and the places of the blocks' terms among those of each shard; both on the executors' disks."""

    rows: DataFrame
    links: DataFrame
    shards: int
    block_parts: int
    shard_parts: int
    n_terms: int
    id_col: str
    id_type: str

    def unpersist(self) -> None:
        self.rows.unpersist()
        self.links.unpersist()


def _shard_of(bucket, shards: int):
    return bucket * shards // LDA_BUCKETS


@contextmanager
def _many_rows_a_batch(spark):
    """Spark measures a batch after each row that it sends to Python; while rows are short, their number (``maxRecordsPerBatch``) is limit enough."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    was = spark.conf.get(name, None)
    spark.conf.set(name, str(2 ** 31 - 1))
    try:
        yield
    finally:
        spark.conf.set(name, was) if was else spark.conf.unset(name)


def document_blocks(counts: DataFrame, id_col: str, block_rows: int = LDA_BLOCK) -> Blocks:
    """Whole documents in blocks of about ``block_rows`` counts, as numbers; strings are read once, here.

    A term falls in a shard by its hash and has a place among the shard's terms,
    so that a block and a shard tell each other numbers alone. Call
    ``unpersist`` after the last round.
    """
    rows = counts.select(id_col, "term", "tf").where(F.col(id_col).isNotNull() & F.col("term").isNotNull())
    id_type, spark = rows.schema[id_col].dataType.simpleString(), counts.sparkSession

    def pack(batches):
        part, made, held, n, few = TaskContext.get().partitionId() << 32, 0, [], 0, min(block_rows, 10_000)
        for batch in (b.slice(a, few) for b in batches for a in range(0, len(b), few)):
            ids = batch.column(0)
            at = pac.index(ids, ids[-1]).as_py() if n + len(batch) >= block_rows else 0
            if at or (n >= block_rows and ids[0] != held[-1].column(0)[-1]):  # all before this row are whole documents
                yield _packed(pa.Table.from_batches([*held, batch.slice(0, at)]), id_col, part + made)
                made, held, n, batch = made + 1, [], 0, batch.slice(at)
            held.append(batch)
            n += len(batch)
        if held:
            yield _packed(pa.Table.from_batches(held), id_col, part + made)

    packed = rows.repartition(id_col).sortWithinPartitions(id_col).mapInArrow(
        pack, f"__block bigint, n_terms bigint, ids array<{id_type}>, lengths binary, places binary, tf binary, tf_type string, terms array<string>, buckets binary")
    cores = spark.sparkContext.defaultParallelism
    blocks = packed.repartition(4 * cores, "__block").persist(StorageLevel.DISK_ONLY)
    with _many_rows_a_batch(spark):
        pairs = blocks.agg(F.sum("n_terms")).first()[0] or 0
    shards = max(1, min(LDA_BUCKETS, max(-(-pairs // LDA_SHARD), min(2 * cores, pairs // 50_000))))
    parts = min(4 * cores, 2 * shards)

    def split(batches):
        for batch in batches:
            for block, terms, buckets in zip(batch.column("__block"), batch.column("terms"), batch.column("buckets")):
                ends = np.searchsorted(_shard_of(np.frombuffer(buckets.as_py(), np.uint16).astype(np.int64), shards), np.arange(shards + 1)).astype(np.int32)
                yield pa.RecordBatch.from_pydict({"__shard": pa.array(np.arange(shards, dtype=np.int32)), "__block": pa.array(np.full(shards, block.as_py(), np.int64)),
                                                  "terms": pa.ListArray.from_arrays(pa.array(ends), terms.values)})

    def number(table: pa.Table) -> pa.Table:
        """Places of each block's terms, and in the row of no block the terms themselves."""
        lists = [t.values for t in table.column("terms")]
        every = pac.unique(pa.chunked_array(lists, pa.string()))
        every = every.take(pac.sort_indices(every))
        at = [pac.index_in(t, value_set=every).to_numpy().astype(np.int32).tobytes() for t in lists]
        return pa.table({"__shard": pa.array(np.full(len(lists) + 1, table.column("__shard")[0].as_py(), np.int32)),
                         "__block": pa.concat_arrays([_column(table, "__block"), pa.nulls(1, pa.int64())]), "n_terms": pa.array([len(every)] * (len(lists) + 1), pa.int64()),
                         "at": pa.array([*at, None], pa.binary()), "terms": pa.array([None] * len(lists) + [every.to_pylist()], pa.list_(pa.string()))})

    links = (blocks.select("__block", "terms", "buckets").mapInArrow(split, "__shard int, __block bigint, terms array<string>")
             .groupBy("__shard").applyInArrow(number, "__shard int, __block bigint, n_terms bigint, at binary, terms array<string>")
             .repartition(parts, "__shard").persist(StorageLevel.DISK_ONLY))
    n_terms = links.where("__block IS NULL").agg(F.sum("n_terms")).first()[0] or 0
    return Blocks(blocks, links, shards, 4 * cores, parts, n_terms, id_col, id_type)


def _numbers(value: bytes, k: int) -> np.ndarray:
    return np.frombuffer(value, np.float64).reshape(k, -1)


def _wire(rows: list[tuple]) -> pa.Table:
    """Rows of ``_OUT``."""
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, [pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.binary()])],
                    ["__shard", "__block", "docs", "value", "whole"])


class _Block:
    """Counts of one block, and what is known of its terms (``p``, k by terms) and documents (``x``, k by documents)."""

    def __init__(self, row: pa.Table, state: pa.Table, k: int):
        get = lambda c, t: np.frombuffer(row.column(c)[0].as_py(), t)
        self.ends = np.concatenate([[0], np.cumsum(get("lengths", np.int32), dtype=np.int64)])
        self.t, self.tf = get("places", np.int32), get("tf", np.dtype(row.column("tf_type")[0].as_py()))
        told = sorted((s, v) for s, d, v in zip(*[state.column(c).to_pylist() for c in ("__shard", "docs", "value")]) if not d)
        self.shards, cuts = [s for s, _ in told], [_numbers(v, k) for _, v in told]
        self.p, self.cuts = np.concatenate(cuts, axis=1), np.cumsum([c.shape[1] for c in cuts])[:-1]
        self.known = ~np.isnan(self.p[0])
        self.p = np.where(self.known, self.p, 0.0)
        mix = [v for d, v in zip(state.column("docs").to_pylist(), state.column("value")) if d]
        self.x = _numbers(mix[0].as_py(), k) if mix else np.full((k, len(self.ends) - 1), 1.0 / k)

    def shares(self, by_term: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences dealt to topics, tf * p_k * x_k / sum over topics, summed by term and by document; unknown terms count nowhere."""
        terms, docs, gaps = np.zeros(self.p.shape), np.zeros(self.x.shape), not self.known.all()
        for a in range(0, len(self.t), _PART):
            b = min(a + _PART, len(self.t))
            d0, d1 = np.searchsorted(self.ends, a, "right") - 1, np.searchsorted(self.ends, b, "left")
            cuts = np.clip(self.ends[d0:d1 + 1], a, b) - a
            own, t = np.diff(cuts), self.t[a:b].astype(np.intp)
            p, x = [row.take(t) for row in self.p], [np.repeat(row[d0:d1], own) for row in self.x]
            whole = p[0] * x[0]
            for i in range(1, len(p)):
                whole += p[i] * x[i]
            with np.errstate(divide="ignore", invalid="ignore"):
                q = self.tf[a:b] / whole
            if gaps:
                q[~self.known[t]] = 0.0
            for i in range(len(p)):
                docs[i, d0:d1] += np.add.reduceat(q * p[i], cuts[:-1])
                if by_term:
                    terms[i] += np.bincount(t, q * x[i], terms.shape[1])
        return terms * self.p, docs * self.x

    def mixes(self, docs: np.ndarray, alpha: float) -> np.ndarray:
        return (docs + alpha) / (docs.sum(axis=0) + len(docs) * alpha)


def _sliced(links: pa.Table, values: np.ndarray | None) -> list[tuple]:
    """What a shard tells each block: the values of the block's terms."""
    at = [(s, b, np.frombuffer(a, np.int32)) for s, b, a in zip(*[links.column(c).to_pylist() for c in ("__shard", "__block", "at")]) if b is not None]
    return [(s, b, False, np.ascontiguousarray(values[:, a]).tobytes(), None) for s, b, a in at]


def _with_links(own: Blocks, columns: list[str], rows: DataFrame, step, schema: str) -> DataFrame:
    """``step(links, rows)`` of every shard."""
    return own.links.select("__shard", *columns).groupBy("__shard").cogroup(rows.repartition(own.shard_parts, "__shard").groupBy("__shard")).applyInArrow(step, schema)


def _over_blocks(own: Blocks, state: DataFrame, step, schema: str) -> DataFrame:
    """``step(block, state)`` of every block."""
    blocks = own.rows.select("__block", "ids", "lengths", "places", "tf", "tf_type")
    return blocks.groupBy("__block").cogroup(state.repartition(own.block_parts, "__block").groupBy("__block")).applyInArrow(step, schema)


def lda_fit(counts: DataFrame, id_col: str, k: int, rounds: int = 10, alpha: float = 0.1, eta: float = 0.01, seed: int = 1,
            blocks: Blocks | None = None) -> DataFrame:
    """``(term, p0..)``: word weights of ``k`` topics, which sum to 1 in each topic.

    Expectation-maximisation with symmetric Dirichlet pseudo-counts ``alpha`` (mix
    of a document) and ``eta`` (words of a topic), from weights dealt by hash. A
    round is one job over blocks of documents (``document_blocks``): shards tell a
    block the weights of its terms, it tells them one sum per term, and the mixes
    of its documents come back to it. Counts themselves are not moved or written again.
    """
    own = blocks or document_blocks(counts, id_col)
    size, shards = own.n_terms, own.shards

    def deal(links: pa.Table) -> pa.Table:
        words = next(w for w in links.column("terms").to_pylist() if w is not None)
        p = [[portable_hash_of(w, i, seed=seed) / HASH_SPACE + 0.5 for w in words] for i in range(k)]
        return _wire([(links.column("__shard")[0].as_py(), None, False, np.array(p, np.float64).tobytes(), None)])

    def tell(links: pa.Table, weights: pa.Table) -> pa.Table:
        return _wire(_sliced(links, _numbers(weights.column("value")[0].as_py(), k)))

    def step(table: pa.Table, state: pa.Table) -> pa.Table:
        b, block = _Block(table, state, k), table.column("__block")[0].as_py()
        terms, docs = b.shares()
        whole = terms.sum(axis=1).tobytes()
        out = [(s, block, False, np.ascontiguousarray(v).tobytes(), whole) for s, v in zip(b.shards, np.split(terms, b.cuts, axis=1))]
        return _wire([*out, (block % shards, block, True, b.mixes(docs, alpha).tobytes(), None)])

    def gather(links: pa.Table, sums: pa.Table) -> pa.Table:
        at = {b: np.frombuffer(a, np.int32) for b, a in zip(links.column("__block").to_pylist(), links.column("at").to_pylist()) if b is not None}
        total, whole, mixes = np.zeros((k, links.column("n_terms")[0].as_py())), np.zeros(k), []
        where, is_docs = sums.column("__block").to_numpy(), sums.column("docs").to_pylist()
        shard = links.column("__shard")[0].as_py()
        for i in np.argsort(where, kind="stable"):
            value = sums.column("value")[int(i)].as_py()
            if is_docs[i]:
                mixes.append((shard, where[i], True, value, None))
            else:
                total[:, at[where[i]]] += _numbers(value, k)
                whole += np.frombuffer(sums.column("whole")[int(i)].as_py(), np.float64)
        p = (total + eta) / (whole + eta * size)[:, None]
        return _wire([(shard, None, False, p.tobytes(), None), *mixes])

    def named(links: pa.Table, weights: pa.Table) -> pa.Table:
        p = _numbers(weights.column("value")[0].as_py(), k)
        words = next(w for w in links.column("terms").to_pylist() if w is not None)
        return pa.table({"term": pa.array(words, pa.string()), **{f"p{i}": pa.array(p[i]) for i in range(k)}})

    now = own.links.select("__shard", "terms").groupBy("__shard").applyInArrow(deal, _OUT)
    for _ in range(rounds):
        told = _with_links(own, ["__block", "at"], now.where("NOT docs"), tell, _OUT)
        sums = _over_blocks(own, told.unionByName(now.where("docs")), step, _OUT)
        now = stage(_with_links(own, ["__block", "n_terms", "at"], sums, gather, _OUT), "lda-round")
    weights = stage(_with_links(own, ["terms"], now.where("NOT docs"), named, "term string, " + ", ".join(f"p{i} double" for i in range(k))), "lda-weights")
    if not blocks:
        own.unpersist()
    return weights


def lda_mix(counts: DataFrame, weights: DataFrame, id_col: str, k: int, rounds: int = 5, alpha: float = 0.1,
            blocks: Blocks | None = None) -> DataFrame:
    """``(id, t0..)``: topic mix of documents under fixed word weights; words the topics do not know are ignored.

    Mixes of documents do not depend on each other, so all rounds of a block are one step.
    """
    own = blocks or document_blocks(counts, id_col)

    def tell(links: pa.Table, weights: pa.Table) -> pa.Table:
        words = [w for w in links.column("terms").to_pylist() if w is not None]
        if not words:
            return _wire([])
        at = pac.index_in(_column(weights, "term"), value_set=pa.array(words[0], pa.string())).fill_null(-1).to_numpy()
        p = np.full((k, len(words[0])), np.nan)
        for i in range(k):
            p[i, at[at >= 0]] = weights.column(f"p{i}").to_numpy()[at >= 0]
        return _wire(_sliced(links, p))

    def step(table: pa.Table, state: pa.Table) -> pa.Table:
        b = _Block(table, state, k)
        for _ in range(rounds):
            b.x = b.mixes(b.shares(by_term=False)[1], alpha)
        some = np.add.reduceat(b.known[b.t], b.ends[:-1], dtype=np.int64) > 0
        return pa.table({id_col: table.column("ids")[0].values.filter(pa.array(some)), **{f"t{i}": pa.array(b.x[i, some]) for i in range(k)}})

    at = F.expr(f"CAST(pmod(crc32(term), {LDA_BUCKETS}) * {own.shards} DIV {LDA_BUCKETS} AS INT)")
    asked = weights.where("term IS NOT NULL").select(at.alias("__shard"), "term", *_shares("p", k))
    told = _with_links(own, ["__block", "at", "terms"], asked, tell, _OUT)
    mix = stage(_over_blocks(own, told, step, f"{id_col} {own.id_type}, " + ", ".join(f"t{i} double" for i in range(k))), "lda-mix")
    if not blocks:
        own.unpersist()
    return mix


def top_words(weights: DataFrame, k: int, m: int) -> DataFrame:
    """``(topic, rank, word, weight)``: the ``m`` heaviest words of each topic (to nine digits; ties by word)."""
    long = weights.select(F.col("term").alias("word"), F.posexplode(F.array(*_shares("p", k))).alias("topic", "weight"))
    order = Window.partitionBy("topic").orderBy(F.round("weight", 9).desc(), "word")  # Spark keeps m rows a topic before the shuffle
    return long.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < m).select("topic", "rank", "word", "weight")
