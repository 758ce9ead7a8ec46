"""Distributed dense numbering and prefix sums (the "Z1" helper).

A window ``row_number() OVER (ORDER BY k)`` without a partition spec moves
every row into one task. Here the order is cut into ranges instead:

1. ``repartitionByRange`` cuts the rows into ranges of the keys, which are then
   sorted inside their partitions. Sampling, comparison and the order of nulls
   and NaN are Spark's own, at any number of ranges. The key columns include a
   unique tie-breaker, so a hot key value is spread over several ranges;
2. the range and the position inside it are written with the rows to the shared
   checkpoint folder, so a lost executor re-reads them and every later use sees
   the same ranges;
3. one aggregate returns a count (or sum) per range: at most one row per range,
   the only data that this module brings to the driver;
4. the offset of a range is added from a literal array of as many numbers.

The steps run while the query is being built (the checkpoint is eager).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ensure_checkpoint_dir

_RANGE = "__range_id"
_POS = "__range_pos"
# monotonically_increasing_id() holds the partition above this bit and the row's position below it.
_POS_BITS = 33


def _default_ranges(spark) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def with_range_id(df: DataFrame, keys: list[str], n_ranges: int | None = None) -> tuple[DataFrame, int]:
    """Attach ``__range_id`` and the position ``__range_pos`` inside it, both in the order of ``keys``."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = n_ranges or _default_ranges(spark)
    at = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
          .withColumn(_POS, F.monotonically_increasing_id()).checkpoint(eager=True))
    return at.withColumns({_RANGE: F.shiftright(_POS, _POS_BITS).cast("int"),
                           _POS: F.col(_POS).bitwiseAND(F.lit((1 << _POS_BITS) - 1))}), n


def _offsets(per_range: dict, n: int) -> list:
    acc, out = 0, []
    for r in range(n):
        out.append(acc)
        acc += per_range.get(r, 0) or 0
    return out


def _offset_col(offsets: list, dtype: str) -> Column:
    arr = F.array(*[F.lit(o).cast(dtype) for o in offsets])
    return F.element_at(arr, F.col(_RANGE) + 1)


def dense_index(df: DataFrame, keys: list[str], out: str = "row_idx",
                n_ranges: int | None = None, start: int = 0) -> DataFrame:
    """``row_number() over (order by keys) - 1 + start`` without a global window.

    ``keys`` must be together unique for a deterministic result; nulls come
    first and NaN last, as in any ascending Spark order.
    """
    ranged, n = with_range_id(df, keys, n_ranges)
    counts = {r[0]: r[1] for r in ranged.groupBy(_RANGE).count().collect()}  # <= n rows
    return (ranged.withColumn(out, F.col(_POS) + _offset_col(_offsets(counts, n), "bigint") + start)
            .drop(_RANGE, _POS))


def prefix_sum(df: DataFrame, keys: list[str], value: str, out: str,
               n_ranges: int | None = None, inclusive: bool = True) -> DataFrame:
    """Running ``sum(value) over (order by keys)`` (rows frame) without a global window."""
    return prefix_sums(df, keys, {out: value}, n_ranges, inclusive)


def prefix_sums(df: DataFrame, keys: list[str], values: dict[str, str],
                n_ranges: int | None = None, inclusive: bool = True) -> DataFrame:
    """Several running sums ``{out: value}`` sharing one range assignment."""
    ranged, n = with_range_id(df, keys, n_ranges)
    aggs = [F.sum(v).alias(o) for o, v in values.items()]
    rows = ranged.groupBy(_RANGE).agg(*aggs).collect()  # <= n rows
    frame = Window.partitionBy(_RANGE).orderBy(_POS).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    for o, v in values.items():
        dtype = df.schema[v].dataType
        dtype_s = "double" if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)) else "bigint"
        offs = _offsets({r[_RANGE]: r[o] for r in rows}, n)
        local = F.coalesce(F.sum(v).over(frame), F.lit(0).cast(dtype_s))
        ranged = ranged.withColumn(o, (local + _offset_col(offs, dtype_s)).cast(dtype_s))
    return ranged.drop(_RANGE, _POS)


def keyed_prefix_sums(df: DataFrame, by: list[str], keys: list[str], values: dict[str, str], n_ranges: int | None = None) -> DataFrame:
    """Running sums of non-negative values within each group of ``by`` in the order of ``keys``.

    One range assignment over (``by``, ``keys``) serves all groups, whatever
    their number and sizes: a group's sums are those of the whole order less
    what stands before its first row.
    """
    run = prefix_sums(df, [*by, *keys], values, n_ranges)
    if not by:
        return run
    start = run.groupBy(*by).agg(*[F.min(F.col(o) - F.col(v)).alias(f"__before_{o}") for o, v in values.items()])
    run = run.join(start, by)
    return run.withColumns({o: F.col(o) - F.col(f"__before_{o}") for o in values}).drop(*[f"__before_{o}" for o in values])
