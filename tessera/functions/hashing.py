"""Portable seeded hash ``H(x)``.

``H(x) = first 8 hex digits of md5(x)`` read as an unsigned 32-bit integer.
The same value is computed by any SQL engine with ``md5`` and hex parsing, so
every seeded split, sample and bootstrap is repeatable and exactly checkable,
and it needs no shuffle or driver state: each row decides for itself.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 2 ** 32
WIDE_SPACE = 2 ** 60


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _md5_prefix(parts, seed, digits: int) -> Column:
    cols = [_as_col(p).cast("string") for p in parts]
    if seed is not None:
        cols.append(F.lit(str(seed)))
    text = cols[0] if len(cols) == 1 else F.concat_ws(":", *cols)
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def portable_hash(*parts, seed: int | str | None = None) -> Column:
    """H(part1 ':' part2 ... [':' seed]) as BIGINT in [0, 2^32)."""
    return _md5_prefix(parts, seed, 8)


def portable_hash_of(*parts, seed: int | str | None = None) -> int:
    """``portable_hash`` of plain values."""
    text = ":".join(str(p) for p in (parts if seed is None else (*parts, seed)))
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def wide_hash(*parts, seed: int | str | None = None) -> Column:
    """The same of 15 hex digits, in [0, 2^60): for draws of positions ``mod N``, even at any table size."""
    return _md5_prefix(parts, seed, 15)


def unit_uniform(*parts, seed: int | str | None = None) -> Column:
    """Deterministic uniform number in [0, 1) from H."""
    return portable_hash(*parts, seed=seed) / F.lit(float(HASH_SPACE))


def sql_hash(expr_sql: str, seed: int | str | None = None) -> str:
    """DuckDB/ANSI text of the same hash, for oracles."""
    text = f"CAST({expr_sql} AS VARCHAR)"
    if seed is not None:
        text = f"({text} || ':{seed}')"
    return f"CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT)"
