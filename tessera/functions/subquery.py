"""One-row statistics attached to every row as a scalar subquery.

``x - (SELECT avg(x) FROM t)``: the aggregate runs once (partial aggregation,
one row out) and its value is substituted into the projection; identical
subqueries are computed once and reused. No join of any kind is planned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scalar_row(agg: DataFrame) -> Column:
    """A one-row aggregate as a struct-valued scalar subquery; use ``s["field"]``."""
    return agg.select(F.struct(*agg.columns)).scalar()


def attach_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Add every column of a one-row aggregate to ``df`` (scalar subqueries)."""
    s = scalar_row(row)
    return df.withColumns({c: s[c] for c in row.columns})
