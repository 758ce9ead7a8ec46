"""Mixing sources to target weights: iterative proportional fitting and calibrated sampling.

Documents fall into cells of source, language and topic; a cell weighs its words.
The cells are raked: in turn each margin's totals are scaled to their targets,
until all three hold or no round brings them closer, which is reported. A document is then kept with a probability in proportion
to its cell's fitted weight over its actual weight, decided by a hash of its key.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import portable_hash
from tessera.llm.common import sized, staged, words

MARGINS = ("source", "lang", "topic")
#: Rounds between two tests of the margins, and the largest error of a share that ends the fit.
ROUNDS = 8
TOLERANCE = 1e-6
#: Margins that still come closer are given up after so many tests.
MAX_TESTS = 25
#: A margin's target shares are its actual shares to this power, rescaled: 1 keeps them, 0 makes them equal.
FLATTEN = 0.95
# Topics by a string that marks them; the first that occurs counts.
TOPICS = (("license", "licensed under"), ("table", " | "), ("contact", "@"), ("marked", "***"), ("shout", "!!"))
REST = "prose"


def topic(text: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, mark in reversed(TOPICS):
        out = F.when(text.contains(mark), F.lit(name)).otherwise(out)
    return F.coalesce(out, F.lit(REST))


def tokens(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def cells(docs: DataFrame, text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """Words of each (source, lang, topic); null and empty names are one. Cells without words are left out."""
    t = docs[text]
    return (docs.select(F.coalesce(docs[source].cast("string"), F.lit("")).alias("source"), F.coalesce(docs[lang].cast("string"), F.lit("")).alias("lang"),
                        topic(t).alias("topic"), tokens(t).alias("n")).groupBy(*MARGINS).agg(F.sum("n").alias("n")).where("n > 0"))


def rake(cell: DataFrame, targets: dict[str, Column | str], rounds: int = ROUNDS) -> DataFrame:
    """``cell`` plus the fitted weight ``w``. ``targets`` name a target weight for each margin's value, repeated in its cells.

    Every step multiplies a margin's cells by target over total. The number of
    cells depends on the names alone, not on the documents.
    """
    out = cell if "w" in cell.columns else cell.withColumn("w", F.col("n").cast("double"))
    for _ in range(rounds):
        for m in MARGINS:
            total = F.sum("w").over(Window.partitionBy(m))
            out = out.withColumn("w", F.coalesce(F.try_divide(F.col("w") * targets[m], total), F.lit(0.0)))
    return out


def flattened(cell: DataFrame, power: float = FLATTEN) -> DataFrame:
    """Add the default targets ``t_<margin>``: each value's total to a power, scaled so that a margin sums to one."""
    out = cell
    for m in MARGINS:
        out = out.withColumn("__c", F.count("*").over(Window.partitionBy(m))).withColumn(f"t_{m}", F.pow(F.sum("n").over(Window.partitionBy(m)).cast("double"), F.lit(power)))
        # one row counts for each value: a cell carries its share of the value's target
        sums = out.agg(F.sum(F.col(f"t_{m}") / F.col("__c"))).first()[0] or 1.0
        out = out.withColumn(f"t_{m}", F.col(f"t_{m}") / F.lit(float(sums))).drop("__c")
    return out


def targeted(cell: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """``flattened`` with the targets of some margins replaced by tables ``value``, ``share``.

    Values that a table does not name divide what it leaves of 1 by their actual
    words; the shares of the values that occur are rescaled to sum to one.
    """
    out = flattened(cell)
    for m, table in targets.items():
        if m not in MARGINS:
            raise ValueError(f"no margin {m}: {', '.join(MARGINS)}")
        given = table.select(F.col("value").cast("string").alias(m), F.col("share").cast("double").alias("__share"))
        left = max(0.0, 1.0 - (given.agg(F.sum("__share")).first()[0] or 0.0))
        values = cell.groupBy(m).agg(F.sum("n").alias("__n")).join(given, m, "left")
        free = values.where("__share IS NULL").agg(F.sum("__n")).first()[0] or 1
        values = values.select(m, F.coalesce("__share", F.col("__n") * F.lit(left / float(free))).alias("__t"))
        whole = values.agg(F.sum("__t")).first()[0]
        if not whole:
            raise ValueError(f"no value of {m} that occurs has a share")
        out = out.drop(f"t_{m}").join(values.select(m, (F.col("__t") / F.lit(float(whole))).alias(f"t_{m}")), m)
    return out


def margin_errors(fitted: DataFrame) -> DataFrame:
    """``margin``, ``value``, ``target`` and ``reached`` (shares) of every value of a fitted table."""
    per = [fitted.groupBy(F.lit(m).alias("margin"), F.col(m).alias("value")).agg(F.first(f"t_{m}").alias("target"), F.sum("w").alias("reached")) for m in MARGINS]
    return per[0].unionByName(per[1]).unionByName(per[2])


def fit(cell: DataFrame) -> DataFrame:
    """``rake`` until every margin is within ``TOLERANCE``; warns of margins that cannot be reached together."""
    out, was = cell, None
    for _ in range(MAX_TESTS):
        out = staged(rake(out, {m: F.col(f"t_{m}") for m in MARGINS}), "mixing-fit")
        off = margin_errors(out).withColumn("error", F.abs(F.col("reached") - F.col("target")))
        worst = off.agg(F.max("error")).first()[0] or 0.0
        if worst <= TOLERANCE:
            return out
        if was is not None and worst > 0.99 * was:
            break
        was = worst
    rows = off.orderBy(F.desc("error")).limit(10).collect()
    warnings.warn("targets not reached: " + "; ".join(f"{r['margin']} {r['value']!r} {r['reached']:.6f} for {r['target']:.6f}" for r in rows), stacklevel=3)
    return out


def plan(docs: DataFrame, text: str = "text", source: str = "source", lang: str = "lang", targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """``source``, ``lang``, ``topic``, ``p``: the keeping probability of each cell's documents.

    Probabilities are fitted over actual weight, scaled so that the largest is 1:
    the sample has the target shares in expectation and loses no more than it must.
    ``targets``: a table ``value``, ``share`` for each margin with targets of its
    own; the others keep nearly their actual shares (``FLATTEN``).
    """
    base = staged(cells(docs, text, source, lang), "mixing-cells")
    fitted = fit(targeted(base, targets or {}))
    top = fitted.agg(F.max(F.col("w") / F.col("n"))).first()[0] or 1.0
    return fitted.select(*MARGINS, (F.col("w") / F.col("n") / F.lit(float(top))).alias("p"))


def sample(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", seed: int = 7,
           targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """``docs`` plus ``mix_topic``, ``mix_tokens``, ``mix_p`` and ``mix_kept``; one row per input row.

    A text without words (null, empty) has no weight: its probability is 1, so
    it is kept. The draw depends on the key alone, so rows with one key and one
    cell are kept or left together; null keys draw as one key. The cells are few
    and joined by size; a hot cell is split by the adaptive skew join. An empty
    table gives no rows; a very long text weighs its words like any other;
    columns that are named like the new ones are replaced.
    """
    rates = sized(plan(docs, text, source, lang, targets)).select(*[F.col(m).alias(f"__m_{m}") for m in MARGINS], F.col("p").alias("__m_p"))
    own = docs.withColumns({"__m_s": F.coalesce(docs[source].cast("string"), F.lit("")), "__m_l": F.coalesce(docs[lang].cast("string"), F.lit("")),
                            "mix_topic": topic(docs[text]), "mix_tokens": tokens(docs[text])})
    own = own.withColumn("mix_topic", F.coalesce("mix_topic", F.lit(REST)))
    joined = own.join(rates, (F.col("__m_s") == F.col("__m_source")) & (F.col("__m_l") == F.col("__m_lang")) & (F.col("mix_topic") == F.col("__m_topic")), "left")
    p = F.when(F.col("mix_tokens") > 0, F.coalesce("__m_p", F.lit(1.0))).otherwise(F.lit(1.0))
    draw = (portable_hash(F.coalesce(docs[key].cast("string"), F.lit("")), seed=seed) + 0.5) / F.lit(float(2**32))
    out = joined.withColumn("mix_p", p).withColumn("mix_kept", draw < F.col("mix_p"))
    return out.drop("__m_s", "__m_l", "__m_p", *[f"__m_{m}" for m in MARGINS])
