"""File sources and sinks with explicit schemas.

Schema inference is a second full pass over the data; every reader here takes
a schema. Line numbers of text files come from the file path, the block
offset and the row id inside a split (all deterministic for a file scan), then
the distributed numbering helper.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.ordering import dense_index


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True, multiline: bool = False,
             sep: str = ",", comment: str | None = None) -> DataFrame:
    r = (spark.read.schema(schema).option("header", header).option("multiLine", multiline)
         .option("escape", '"').option("quote", '"').option("sep", sep).option("mode", "PERMISSIVE"))
    if comment:
        r = r.option("comment", comment)
    return r.csv(path)


def read_csv_with_markers(spark: SparkSession, path: str, names: list[str], types: dict[str, str],
                          markers: list[str], header: bool = False) -> DataFrame:
    """Read every column as text, turn null markers ('?', 'NA', '#DIV/0!', '') into
    NULL, then cast leniently (bad text becomes NULL, not an error)."""
    schema = ", ".join(f"`{n}` string" for n in names)
    raw = read_csv(spark, path, schema, header=header)
    cols = []
    for n in names:
        c = F.when(F.trim(F.col(n)).isin(*markers) | (F.trim(F.col(n)) == ""), F.lit(None)).otherwise(F.col(n))
        t = types.get(n, "string")
        cols.append((c.try_cast(t) if t != "string" else c).alias(n))
    return raw.select(*cols)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line_no, line)``: one row per line, numbered in file order (files in path order)."""
    df = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("__f"), F.col("_metadata.file_block_start").alias("__b"),
        F.monotonically_increasing_id().alias("__m"), F.col("value").alias("line"))
    return dense_index(df, ["__f", "__b", "__m"], "line_no").select("line_no", "line")


def read_whole(spark: SparkSession, path: str) -> DataFrame:
    """``(file, text)``: the whole text of each file; for files that fit a task's memory."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def read_json(spark: SparkSession, path: str, schema: str, multiline: bool = False) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> None:
    """Array/struct columns are written as JSON text (CSV has no nesting)."""
    out = df.select(*[F.to_json(c).alias(c) if df.schema[c].dataType.typeName() in ("array", "struct", "map")
                      else F.col(c) for c in df.columns])
    out.write.mode("overwrite").option("sep", sep).option("header", header).option("escape", '"').csv(path)


def write_xml(df: DataFrame, path: str, root_tag: str, row_tag: str) -> None:
    """Columns named ``_x`` become attributes ``x`` of each row element."""
    df.write.mode("overwrite").format("xml").option("rootTag", root_tag).option("rowTag", row_tag).save(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def grid(spark: SparkSession, lo, hi, n: int, kind: str = "linear") -> DataFrame:
    """linspace / logspace (base 10 exponents lo..hi) with ``n`` points; lo, hi may be Columns."""
    i = F.col("id")
    lo_c = lo if not isinstance(lo, (int, float)) else F.lit(float(lo))
    hi_c = hi if not isinstance(hi, (int, float)) else F.lit(float(hi))
    x = lo_c + i * (hi_c - lo_c) / F.lit(max(n - 1, 1))
    if kind == "log":
        x = F.pow(F.lit(10.0), x)
    return spark.range(n).select(i.alias("i"), x.alias("x"))


def arange(spark: SparkSession, start, stop, step: float) -> DataFrame:
    start_c = start if not isinstance(start, (int, float)) else F.lit(float(start))
    stop_c = stop if not isinstance(stop, (int, float)) else F.lit(float(stop))
    n = F.ceil((stop_c - start_c) / F.lit(step))
    return spark.range(1).select(F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)).alias("i")).select(
        "i", (start_c + F.col("i") * F.lit(step)).alias("x"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
