"""Hypothesis tests, standard errors, confidence intervals, density curves (H rows).

The data work is one aggregate (counts, means, variances: partial aggregation,
one row out). The tail probability is then computed on that single row by a
vectorised pandas UDF over the scalar helpers.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tessera.functions.subquery import attach_row

from tessera.functions.distributions import t_pvalue, z_for_level
from tessera.operators.profile import histogram


def _pvalue_col(t_col: str, df_col: str, alternative: str):
    @F.pandas_udf("double")
    def pval(t: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([t_pvalue(a, b, alternative) if pd.notna(a) and pd.notna(b) else float("nan")
                          for a, b in zip(t, d)])
    return pval(F.col(t_col), F.col(df_col))


def welch_stats(df: DataFrame, value: str, group: str, g1, g2) -> DataFrame:
    """One row: n, mean, sample variance of both groups, Welch t and its df."""
    v = F.col(value).cast("double")
    in1, in2 = F.col(group) == F.lit(g1), F.col(group) == F.lit(g2)
    r = df.where(F.col(group).isin(g1, g2)).agg(
        F.count(F.when(in1, v)).alias("n1"), F.avg(F.when(in1, v)).alias("mean1"),
        F.var_samp(F.when(in1, v)).alias("var1"),
        F.count(F.when(in2, v)).alias("n2"), F.avg(F.when(in2, v)).alias("mean2"),
        F.var_samp(F.when(in2, v)).alias("var2"))
    a, b = F.col("var1") / F.col("n1"), F.col("var2") / F.col("n2")
    return r.withColumns({
        "t_stat": (F.col("mean1") - F.col("mean2")) / F.sqrt(a + b),
        "dof": (a + b) * (a + b) / (a * a / (F.col("n1") - 1) + b * b / (F.col("n2") - 1))})


def welch_ttest(df: DataFrame, value: str, group: str, g1, g2, alternative: str = "two-sided") -> DataFrame:
    s = welch_stats(df, value, group, g1, g2)
    return s.withColumn("p_value", _pvalue_col("t_stat", "dof", alternative))


def one_sample_stats(df: DataFrame, value: str, mu: float) -> DataFrame:
    v = F.col(value).cast("double")
    r = df.agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd"))
    return r.withColumns({"t_stat": (F.col("mean") - F.lit(mu)) / (F.col("sd") / F.sqrt("n")),
                          "dof": (F.col("n") - 1).cast("double")})


def one_sample_ttest(df: DataFrame, value: str, mu: float, alternative: str = "two-sided") -> DataFrame:
    return one_sample_stats(df, value, mu).withColumn("p_value", _pvalue_col("t_stat", "dof", alternative))


def standard_error(df: DataFrame, value: str, by: list[str] | tuple = ()) -> DataFrame:
    v = F.col(value).cast("double")
    return df.groupBy(*by).agg(F.count(v).alias("n"), F.avg(v).alias("mean"),
                               (F.stddev_samp(v) / F.sqrt(F.count(v))).alias("se"))


def confidence_intervals(df: DataFrame, value: str, levels: list[float]) -> DataFrame:
    """Normal CI per level: mean +- z * SE (z from the level, computed once)."""
    se = standard_error(df, value)
    zs = F.array(*[F.struct(F.lit(lv).alias("level"), F.lit(z_for_level(lv)).alias("z")) for lv in levels])
    out = se.select("n", "mean", "se", F.inline(zs))
    return out.withColumns({"margin": F.col("z") * F.col("se"),
                            "lower": F.col("mean") - F.col("z") * F.col("se"),
                            "upper": F.col("mean") + F.col("z") * F.col("se")})


def density_curve(df: DataFrame, value: str, points: int) -> DataFrame:
    """Normal density (sample mean, sample std) on ``points`` grid values from min to max."""
    st = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.avg(value).alias("m"),
                F.stddev_samp(value).alias("s"))  # one row
    grid = df.sparkSession.range(points).withColumnRenamed("id", "i")  # parameter-sized
    g = attach_row(grid, st)
    x = F.col("lo") + F.col("i") * (F.col("hi") - F.col("lo")) / F.lit(points - 1)
    g = g.withColumn("x", x)
    dens = F.exp(-0.5 * F.pow((F.col("x") - F.col("m")) / F.col("s"), 2)) / (F.col("s") * F.lit(math.sqrt(2 * math.pi)))
    return g.select("i", "x", dens.alias("density"))


def density_with_histogram(df: DataFrame, value: str, points: int) -> DataFrame:
    """The curve next to the data: ``n`` values from a grid point up to the next (the last bin holds the maximum)
    and ``empirical``, their share per unit; both null at the last grid point."""
    bins = histogram(df.where(F.col(value).isNotNull()), value, points - 1)
    total = df.agg(F.count(value).alias("__all"))  # one row
    h = attach_row(bins, total).select(F.col("bin").cast("bigint").alias("i"), "n", F.try_divide(F.col("n"), F.col("__all") * (F.col("bin_hi") - F.col("bin_lo"))).alias("empirical"))
    out = density_curve(df, value, points).join(h, "i", "left")
    inner = F.col("i") < points - 1
    return out.withColumns({"n": F.when(inner, F.coalesce("n", F.lit(0))), "empirical": F.when(inner, F.coalesce("empirical", F.lit(0.0)))})
