"""Projection, filtering, cleaning, outliers, encoding and scaling (P rows).

Everything is a column expression except where a statistic must be learned
first (means, quartiles, min/max): then one aggregate produces a single row
whose values are attached as scalar subqueries (no join at all).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tessera.functions.subquery import attach_row

from tessera.operators.quantiles import quantiles


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- P1-P5: projection -------------------------------------------------------

def select_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols)


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def slice_columns(df: DataFrame, start: int | None = None, stop: int | None = None) -> DataFrame:
    """Positional column slice ``df.columns[start:stop]`` (schema only, no data)."""
    return df.select(*df.columns[start:stop])


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def cast_columns(df: DataFrame, types: dict[str, str], lenient: bool = True) -> DataFrame:
    """Cast; ``lenient`` uses ``try_cast`` so bad text becomes NULL, not an error."""
    fn = (lambda c, t: F.expr(f"try_cast(`{c}` AS {t})")) if lenient else (lambda c, t: F.col(c).cast(t))
    return df.withColumns({c: fn(c, t) for c, t in types.items()})


# ---- P6-P11: derived columns -------------------------------------------------

def recode(col, mapping: dict, default=None) -> Column:
    """Dictionary map; misses become ``default`` (NULL unless given)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    out = m[_c(col)]
    return out if default is None else F.coalesce(out, F.lit(default))


def ordinal(col, levels: list[str], unknown: int = -1) -> Column:
    """Code of an ordered category (0-based), ``unknown`` for other values."""
    pos = F.array_position(F.array(*[F.lit(x) for x in levels]), _c(col))
    return F.when(pos > 0, (pos - 1).cast("int")).otherwise(F.lit(unknown))


def ratio(a, b, ndigits: int | None = None) -> Column:
    r = F.try_divide(_c(a).cast("double"), _c(b).cast("double"))
    return F.round(r, ndigits) if ndigits is not None else r


def guarded_ratio(a, b, fill: float = 0.0) -> Column:
    """a / b with division by zero (and NULL) replaced by ``fill``."""
    return F.coalesce(F.try_divide(_c(a).cast("double"), _c(b).cast("double")), F.lit(fill))


def assign_where(cond: Column, value, col) -> Column:
    return F.when(cond, value).otherwise(_c(col))


def concat_key(cols: list[str], sep: str = " ") -> Column:
    return F.concat_ws(sep, *[_c(c).cast("string") for c in cols])


# ---- P12-P16: filters and nulls ----------------------------------------------

def any_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [_c(c).isNull() for c in cols])


def filter_any_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return df.where(any_null(cols or df.columns))


def sentinel_to_null(col, markers: list) -> Column:
    c = _c(col)
    return F.when(c.isin(*markers), F.lit(None)).otherwise(c)


def drop_nulls(df: DataFrame, subset: list[str] | None = None, how: str = "any") -> DataFrame:
    return df.na.drop(how=how, subset=subset)


# ---- P17-P19: column screening -----------------------------------------------

def null_count_row(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Keep columns without NULLs (one aggregate; one row of counts to the driver)."""
    counts = null_count_row(df).first().asDict()
    return df.select(*[c for c in df.columns if counts[c] == 0])


def impute_mean(df: DataFrame, cols: list[str]) -> DataFrame:
    """Column mean imputation: one-row aggregate broadcast to every row."""
    means = df.agg(*[F.avg(c).alias(f"__mean_{c}") for c in cols])
    out = attach_row(df, means)
    out = out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"__mean_{c}")) for c in cols})
    return out.drop(*[f"__mean_{c}" for c in cols])


def unpivot_as_text(df: DataFrame, cols: list[str], id_cols: list[str] | None = None) -> DataFrame:
    """Long form ``(id..., column, value string)`` of the given columns."""
    ids = id_cols or []
    typed = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in cols])
    return typed.unpivot(ids, cols, "column", "value")


def near_zero_variance(df: DataFrame, cols: list[str], freq_cut: float = 95 / 5,
                       unique_cut: float = 10.0) -> DataFrame:
    """Per column: ratio of the two top counts, % distinct, zero-variance and
    near-zero-variance flags. Pure aggregation: a hot value is absorbed by
    partial aggregation and no column's values are gathered in one task.
    """
    n_rows = df.agg(F.count(F.lit(1)).alias("n_rows"))
    long = unpivot_as_text(df, cols).where(F.col("value").isNotNull())
    vc = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))
    top = vc.groupBy("column").agg(F.max("cnt").alias("top1"), F.count(F.lit(1)).alias("n_unique"))
    # columns are few: the per-column table is bounded by the column list
    vc2 = vc.join(F.broadcast(top), "column")
    snd = vc2.groupBy("column").agg(
        F.count_if(F.col("cnt") == F.col("top1")).alias("n_top"),
        F.max(F.when(F.col("cnt") < F.col("top1"), F.col("cnt"))).alias("below"),
        F.first("top1").alias("top1"), F.first("n_unique").alias("n_unique"))
    top2 = F.when(F.col("n_top") > 1, F.col("top1")).otherwise(F.col("below"))
    res = attach_row(snd, n_rows).select(
        "column",
        F.when(F.col("n_unique") <= 1, F.lit(0.0)).otherwise(F.col("top1") / top2).alias("freq_ratio"),
        (F.lit(100.0) * F.col("n_unique") / F.col("n_rows")).alias("pct_unique"),
        (F.col("n_unique") <= 1).alias("zero_var"))
    return res.withColumn("nzv", ((F.col("freq_ratio") > freq_cut) & (F.col("pct_unique") <= unique_cut))
                          | F.col("zero_var"))


# ---- P20-P21: duplicates -----------------------------------------------------

def duplicate_groups(df: DataFrame, cols: list[str], first_by: str | None = None) -> DataFrame:
    """Groups of identical ``cols`` seen more than once, with copy count."""
    aggs = [F.count(F.lit(1)).alias("n_copies")]
    if first_by:
        aggs.append(F.min(first_by).alias(f"first_{first_by}"))
    return df.groupBy(*cols).agg(*aggs).where(F.col("n_copies") > 1)


def dedup_first(df: DataFrame, cols: list[str], order_by: str) -> DataFrame:
    """Keep the first row (lowest ``order_by``) of each group of duplicates.

    ``min(struct(order, row))`` is partially aggregated map-side, so a value
    repeated in a third of the rows never lands in one task as raw rows.
    """
    others = [c for c in df.columns if c not in cols and c != order_by]
    best = F.min(F.struct(F.col(order_by), *[F.col(c) for c in others])).alias("__b")
    return df.groupBy(*cols).agg(best).select(*cols, "__b.*").select(*df.columns)


# ---- P22-P25: outliers and rules ---------------------------------------------

def iqr_fences(df: DataFrame, col: str, factor: float = 1.5, by: list[str] | tuple = ()) -> DataFrame:
    """``(by..., q1, q3, iqr, lower, upper)`` with exact quartiles."""
    q = quantiles(df, col, [0.25, 0.75], by, ["q1", "q3"])
    return q.select(*by, "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
                    (F.col("q1") - factor * (F.col("q3") - F.col("q1"))).alias("lower"),
                    (F.col("q3") + factor * (F.col("q3") - F.col("q1"))).alias("upper"))


def flag_outliers(df: DataFrame, col: str, factor: float = 1.5) -> DataFrame:
    f = iqr_fences(df, col, factor)
    out = attach_row(df, f.select("lower", "upper"))
    x = F.col(col)
    return out.withColumn("is_outlier", (x < F.col("lower")) | (x > F.col("upper")))


def cap_iqr(df: DataFrame, cols: list[str], factor: float = 1.5) -> DataFrame:
    """Negatives to 0 first, then quartiles of the result, then cap at Q3 + f*IQR."""
    out = df.withColumns({c: F.greatest(F.col(c).cast("double"), F.lit(0.0)) for c in cols})
    for c in cols:
        f = quantiles(out, c, [0.25, 0.75], (), [f"__q1_{c}", f"__q3_{c}"])
        up = (F.col(f"__q3_{c}") + factor * (F.col(f"__q3_{c}") - F.col(f"__q1_{c}"))).alias(f"__up_{c}")
        out = (attach_row(out, f.select(up))
               .withColumn(c, F.least(F.col(c), F.col(f"__up_{c}"))).drop(f"__up_{c}"))
    return out


def cap_percentile(df: DataFrame, cols: list[str], p: float = 0.95) -> DataFrame:
    out = df
    for c in cols:
        q = quantiles(df, c, [p], (), [f"__cap_{c}"])
        out = attach_row(out, q)
    out = out.withColumns({c: F.least(F.col(c).cast("double"), F.col(f"__cap_{c}")) for c in cols})
    return out.drop(*[f"__cap_{c}" for c in cols])


def rule_override(pred, rule: Column, value) -> Column:
    return F.when(rule, F.lit(value)).otherwise(_c(pred))


# ---- P26-P31: encoding, scaling, features ------------------------------------

def dummies(df: DataFrame, col: str, levels: list, drop_first: bool = False, prefix: str | None = None) -> DataFrame:
    """0/1 column per given level, in the order given.

    A wide frame has its levels in its schema, so they are part of the request;
    ``categories.dummies_long`` learns levels from the data, however many.
    """
    use = levels[1:] if drop_first else levels
    pre = prefix or col
    return df.withColumns({f"{pre}_{v}": (F.col(col) == F.lit(v)).cast("int") for v in use})


def standard_scale(train: DataFrame, test: DataFrame, cols: list[str], ddof: int = 0) -> DataFrame:
    """Fit mean/std on ``train`` (population std by default), apply to ``test``."""
    sd = F.stddev_pop if ddof == 0 else F.stddev_samp
    stats = train.agg(*[F.avg(c).alias(f"__m_{c}") for c in cols], *[sd(c).alias(f"__s_{c}") for c in cols])
    out = attach_row(test, stats)
    out = out.withColumns({c: F.try_divide(F.col(c) - F.col(f"__m_{c}"), F.col(f"__s_{c}")) for c in cols})
    return out.drop(*[f"__m_{c}" for c in cols], *[f"__s_{c}" for c in cols])


def minmax_scale(train: DataFrame, test: DataFrame, cols: list[str]) -> DataFrame:
    stats = train.agg(*[F.min(c).alias(f"__lo_{c}") for c in cols], *[F.max(c).alias(f"__hi_{c}") for c in cols])
    out = attach_row(test, stats)
    rng = {c: F.col(f"__hi_{c}") - F.col(f"__lo_{c}") for c in cols}
    out = out.withColumns({c: F.coalesce(F.try_divide(F.col(c) - F.col(f"__lo_{c}"), rng[c]), F.lit(0.0))
                           for c in cols})
    return out.drop(*[f"__lo_{c}" for c in cols], *[f"__hi_{c}" for c in cols])


def polynomial(df: DataFrame, col: str, degree: int) -> DataFrame:
    return df.withColumns({f"{col}_p{d}": F.pow(F.col(col).cast("double"), d) for d in range(1, degree + 1)})
