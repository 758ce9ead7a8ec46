"""Aggregations and profiling (A rows): long-form results, one pass each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tessera.functions.subquery import attach_row

from tessera.operators.clean import unpivot_as_text
from tessera.operators.quantiles import quantiles


def value_counts(df: DataFrame, cols: list[str], normalize: bool = False) -> DataFrame:
    out = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    if normalize:
        total = df.agg(F.count(F.lit(1)).alias("__total"))  # one row
        out = attach_row(out, total).withColumn("share", F.col("n") / F.col("__total")).drop("__total")
    return out


def share_within(df: DataFrame, group: list[str], label: str) -> DataFrame:
    """Share of each label inside its group: counts, then group totals joined back."""
    c = df.groupBy(*group, label).agg(F.count(F.lit(1)).alias("n"))
    tot = c.groupBy(*group).agg(F.sum("n").alias("__g"))
    return c.join(tot, group).withColumn("share", F.col("n") / F.col("__g")).drop("__g")


def _long_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    typed = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    return typed.unpivot([], cols, "column", "value")


def describe_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, std (ddof 1), min, 25/50/75 % (exact), max per column."""
    long = _long_numeric(df, cols)
    base = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = quantiles(long, "value", [0.25, 0.5, 0.75], ["column"], ["p25", "p50", "p75"])
    return base.join(q, "column", "left")


def describe_categorical(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, unique, top (most frequent, ties to the smallest value), freq."""
    long = unpivot_as_text(df, cols).where(F.col("value").isNotNull())
    vc = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))
    return vc.groupBy("column").agg(
        F.sum("cnt").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct((-F.col("cnt")).alias("a"), F.col("value").alias("b"))).alias("top"),
        F.max("cnt").alias("freq"))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or df.columns
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return row.unpivot([], cols, "column", "n_null")


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """All pairs in one aggregate, long form ``(a, b, r)``."""
    pairs = [(a, b) for a in cols for b in cols]
    row = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    long = row.unpivot([], [f"{a}__{b}" for a, b in pairs], "pair", "r")
    return long.select(F.split("pair", "__")[0].alias("a"), F.split("pair", "__")[1].alias("b"), "r")


def collinear_pairs(corr_long: DataFrame, threshold: float) -> DataFrame:
    """Pairs a < b with |r| >= threshold; the second column is the one to drop."""
    return (corr_long.where((F.col("a") < F.col("b")) & (F.abs("r") >= threshold))
            .withColumn("drop_column", F.col("b")))


def histogram(df: DataFrame, col: str, bins: int, by: list[str] | tuple = ()) -> DataFrame:
    """Equal-width bins over [min, max]; the max value falls in the last bin."""
    rng = df.agg(F.min(col).alias("__lo"), F.max(col).alias("__hi"))  # one row
    x = attach_row(df.select(*by, F.col(col).cast("double").alias("x")), rng)
    w = (F.col("__hi") - F.col("__lo")) / bins
    b = F.least(F.floor((F.col("x") - F.col("__lo")) / w), F.lit(bins - 1)).cast("int")
    b = F.when(w == 0, F.lit(0)).otherwise(b)
    x = x.withColumn("bin", b)
    return x.groupBy(*by, "bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.first(F.col("__lo") + F.col("bin") * w).alias("bin_lo"),
        F.first(F.col("__lo") + (F.col("bin") + 1) * w).alias("bin_hi"))


def box_stats(df: DataFrame, value: str, by: list[str], factor: float = 1.5) -> DataFrame:
    """Per group: quartiles, whiskers (extreme values inside the fences), outlier count."""
    q = quantiles(df, value, [0.25, 0.5, 0.75], by, ["q1", "median", "q3"])
    j = df.select(*by, F.col(value).cast("double").alias("v")).join(q, by)
    lo = F.col("q1") - factor * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + factor * (F.col("q3") - F.col("q1"))
    inside = (F.col("v") >= lo) & (F.col("v") <= hi)
    return j.groupBy(*by).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col("v"))).alias("whisker_lo"), F.max(F.when(inside, F.col("v"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"))


def std_coverage(df: DataFrame, col: str, ks=(1, 2, 3)) -> DataFrame:
    st = df.agg(F.avg(col).alias("__m"), F.stddev_samp(col).alias("__s"))  # one row
    x = attach_row(df.select(F.col(col).cast("double").alias("x")), st)
    aggs = [F.avg(((F.col("x") >= F.col("__m") - k * F.col("__s")) & (F.col("x") <= F.col("__m") + k * F.col("__s")))
                  .cast("double")).alias(f"within_{k}sd") for k in ks]
    return x.agg(*aggs)


def _fingerprint(cols: list[Column]) -> Column:
    """128 bits of the texts of some columns, each with its length, so that no two rows run together."""
    text = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in cols]
    return F.unhex(F.md5(F.concat(*text).cast("binary")))


def _as_text(field) -> Column:
    c = F.col(f"`{field.name}`")
    if field.dataType.typeName() in ("double", "float"):
        c = F.when(c == 0, F.lit(0.0)).otherwise(c)  # the two zeros are one value
    return (F.to_json(c) if field.dataType.typeName() in ("array", "map", "struct") else c.cast("string"))


def profile(df: DataFrame) -> DataFrame:
    """Per column: rows, nulls, distinct, numeric min/max/mean (long form), and the duplicate rows of the table.

    ``n_duplicates`` counts the rows that repeat an earlier one in all columns.
    One pass turns a row into the 128-bit fingerprints of its values and of the
    whole row; counting equal fingerprints, first within the tasks, answers all
    columns at once.
    """
    num = {f.name for f in df.schema if f.dataType.typeName() in ("integer", "long", "double", "float", "short")}
    texts = {f.name: _as_text(f) for f in df.schema}
    marks = [F.struct(F.lit(i).alias("i"), F.when(texts[c].isNotNull(), _fingerprint([texts[c]])).alias("h")) for i, c in enumerate(df.columns)]
    marks.append(F.struct(F.lit(-1).alias("i"), _fingerprint(list(texts.values())).alias("h")))
    counts = df.select(F.inline(F.array(*marks))).groupBy("i", "h").agg(F.count(F.lit(1)).alias("n"))
    per = counts.groupBy("i").agg(F.sum("n").alias("rows"), F.count("h").alias("distinct"), F.sum(F.when(F.col("h").isNull(), F.col("n")).otherwise(0)).alias("nulls"))
    seen = per.agg(F.map_from_entries(F.collect_list(F.struct("i", F.struct("rows", "distinct", "nulls")))).alias("m"))  # a row per column
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c in df.columns:
        if c in num:
            aggs += [F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max"),
                     F.avg(c).alias(f"{c}__mean")]
    row = attach_row(df.agg(*aggs), seen)
    none = F.lit(None).cast("double")
    of = lambda i, name: F.coalesce(F.try_element_at("m", F.lit(i))[name], F.lit(0))
    items = [F.struct(F.lit(c).alias("column"), F.col("__rows").alias("n_rows"),
                      of(i, "nulls").alias("n_null"), of(i, "distinct").alias("n_distinct"),
                      (F.col(f"{c}__min") if c in num else none).alias("min"),
                      (F.col(f"{c}__max") if c in num else none).alias("max"),
                      (F.col(f"{c}__mean") if c in num else none).alias("mean"),
                      (F.col("__rows") - of(-1, "distinct")).alias("n_duplicates")) for i, c in enumerate(df.columns)]
    return row.select(F.inline(F.array(*items)))


def vector_centroid(df: DataFrame, vec: str, by: list[str]) -> DataFrame:
    """Mean vector per group, long form ``(by..., dim, mean)``."""
    ex = df.select(*by, F.posexplode(vec).alias("dim", "x"))
    return ex.groupBy(*by, "dim").agg(F.avg("x").alias("mean"))
