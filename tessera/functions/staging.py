"""Tables that several steps read: written once in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir, shuffle_partitions

#: A table counted to have at most this many rows may be broadcast; a longer one is joined by shuffle.
BROADCAST_ROWS = 20_000
#: Bytes of files that one partition of a hashed table may hold.
HASHED_BYTES = 16 << 20


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Later steps read only the columns they use, a lost executor reads files
    again instead of repeating the steps before, and plans stay short.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/tessera-{label}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hinted(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A staged table with a broadcast hint if its count is at most ``rows``."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def plan_bytes(df: DataFrame) -> int:
    """Spark's estimate of the size of ``df``; of files, their bytes by the columns that are read."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def hashed(df: DataFrame) -> DataFrame:
    """A staged table of unique keys; hinted, if it is too large to broadcast, to be hashed by partition in a join, so that the other side is not sorted."""
    spark = df.sparkSession
    most = int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    return df.hint("shuffle_hash") if most < plan_bytes(df) <= HASHED_BYTES * shuffle_partitions(spark) else df
