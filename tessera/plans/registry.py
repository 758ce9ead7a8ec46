"""Query catalog: key -> (spark query, DuckDB oracle text).

Plans bind the library's operators to the test tables. Each key follows the
operator ids of the survey inventory. An oracle is given only where the
result is deterministic and expressible in plain SQL.
"""

from __future__ import annotations

import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.session import ensure_checkpoint_dir, pin_utc, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TABLE_NAMES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


class Tables:
    """Lazy parquet tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        return self._cache[name]


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, t: Tables) -> DataFrame`` under ``key``."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_utc(spark)
            ensure_checkpoint_dir(spark)
            ship_package(spark)
            return fn(spark, Tables(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = textwrap.dedent(sql).strip()
        return fn
    return deco


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    import uuid
    from tessera.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera-{name}-{uuid.uuid4().hex[:12]}"
