"""Helpers shared by the text operators: staging, barriers, Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir, ship_package

# The six ASCII white-space characters that separate words.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of re-running the
    steps before them, and later uses do not repeat them.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A table of at most this many rows may be broadcast; a longer one is joined by shuffle.
BROADCAST_ROWS = 20_000


def sized(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to be short; for staged tables, whose count reads no data."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def schema_of(df: DataFrame, names: list[str], more: str) -> str:
    """Schema text of some columns of a table and of further ones."""
    return ", ".join([f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names] + [more])


def barrier(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns through a one-row generator.

    The optimizer merges plain projections and would copy an array expression
    into every lambda that mentions it; a generator's output is computed once.
    """
    row = F.struct(*[c.alias(k) for k, c in cols.items()])
    return df.select("*", F.inline(F.array(row)))


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text (null: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def arrow_map(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with the package shipped to the workers.

    Workers outlive their tasks: at its end, a task gives back the memory that
    the allocators of Python, Arrow and C would hold for the next one.
    """
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # where the C library has it
                trim(0)

    return df.mapInArrow(run, schema)


def slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each slice holds about ``max_bytes`` of ``column`` (one row at least)."""
    for b in batches:
        if not b.num_rows:
            continue
        size = _sizes(b, column)
        lo = 0
        while lo < b.num_rows:
            base = size[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(size, base + max_bytes, side="right")))
            yield b.slice(lo, hi - lo)
            lo = hi


def _sizes(b: pa.RecordBatch, column: str):
    """Running byte lengths of a string or binary column."""
    return np.cumsum(pc.fill_null(pc.binary_length(b.column(b.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False))
