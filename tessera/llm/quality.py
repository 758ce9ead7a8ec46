"""Quality rules with host-level verdicts (DataFrame functions only).

Every document is measured and held against five rules. Failures are summed by
host, the failure rate of a host is shrunk towards all hosts by a beta prior
fitted to their counts (beta-binomial moments, weighted by documents, so that the
sampling noise of small hosts is not taken for a difference between hosts), and a host whose shrunken rate
passes a limit is judged strictly on that rule: its documents that fail the
rule go. On other hosts only the base rules reject.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SPACE, barrier, sized, staged, words

WINDOW = 8
# Limits of the rules.
MIN_WORDS, MAX_REPEAT_PCT, MAX_SYMBOL_PCT, MAX_DUP_LINE_PCT, MAX_MEAN_WORD = 20, 30, 10, 30, 12
STRICT_RATE = 0.5
RULES = ("short", "repeats", "symbols", "dup_lines", "long_words")


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0).cast("bigint"), lambda a, x: a + x)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines``, ``n_dup_lines``, ``n_repeat_words``.

    A null or empty text has zeros. ``n_lines`` counts lines with a word.
    Repeats are found by the hashes of the 8-word windows of one text, sorted:
    equal windows become neighbours, and the starts of repeated windows are
    sorted again and their words counted once. The working columns start with
    ``__q_``; the work is linear in a text but for the sorts.
    """
    w, h, win, s, pos = (F.col(f"__q_{c}") for c in ("words", "hash", "win", "sorted", "pos"))
    t = F.coalesce(docs[text], F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    out = barrier(docs, __q_words=words(docs[text]), __q_lines=lines,
                  n_symbols=F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("bigint"))
    out = barrier(out, __q_hash=F.transform(w, lambda x: F.xxhash64(x)), n_words=F.size(w).cast("bigint"),
                  word_chars=F.length(F.array_join(w, "")).cast("bigint"), n_lines=F.size("__q_lines").cast("bigint"),
                  n_dup_lines=(F.size("__q_lines") - F.size(F.array_distinct("__q_lines"))).cast("bigint"))
    starts = F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW)
    none = F.array().cast("array<bigint>")
    out = barrier(out, __q_win=F.when(F.col("n_words") >= WINDOW, F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))).otherwise(none))
    hashed = F.transform(win, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    out = barrier(out, __q_sorted=F.when(F.size(win) > F.size(F.array_distinct(win)), F.sort_array(hashed)))
    twice = F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
    out = barrier(out, __q_pos=F.sort_array(F.transform(twice, lambda x: x["i"])))
    own = F.transform(pos, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(pos, i + 1) - p, F.lit(WINDOW))))
    return out.withColumn("n_repeat_words", F.coalesce(_sum(own), F.lit(0)).cast("bigint")).drop(
        "__q_words", "__q_lines", "__q_hash", "__q_win", "__q_sorted", "__q_pos")


def failures() -> dict[str, Column]:
    """Whether a measured document fails each rule."""
    c = F.col
    return {
        "short": c("n_words") < MIN_WORDS,
        "repeats": 100 * c("n_repeat_words") > MAX_REPEAT_PCT * c("n_words"),
        "symbols": 100 * c("n_symbols") > MAX_SYMBOL_PCT * c("word_chars"),
        "dup_lines": 100 * c("n_dup_lines") > MAX_DUP_LINE_PCT * c("n_lines"),
        "long_words": c("word_chars") > MAX_MEAN_WORD * c("n_words"),
    }


def beta_prior(hosts: int, n: float, n2: float, failed: float, squares: float) -> tuple[float, float]:
    """``(mean, rho)`` from the numbers of hosts, documents, their squares and failures by host, and the sum of ``failures^2 / n``."""
    mean = failed / n if n else 0.0
    room = n - n2 / n - (hosts - 1) if n else 0.0
    if mean * (1 - mean) <= 0 or room <= 1e-9:
        return mean, 0.0
    return mean, ((squares - failed * failed / n) / (mean * (1 - mean)) - (hosts - 1)) / room


def host_verdicts(measured: DataFrame, host: str) -> DataFrame:
    """``host`` and, for each rule, ``strict_<rule>``: whether the shrunken failure rate passes the limit.

    The prior of a rule has the mean rate of all documents, and the correlation
    within hosts that explains how far the rates of ``k`` hosts spread around it:
    the weighted sum of squares is expected to be ``m (1 - m) (k - 1 + rho (N -
    sum(n^2) / N - k + 1))``. A spread of no more than sampling noise, or hosts
    of one document each, which cannot show one, give ``rho = 0``: every host
    gets the mean. Otherwise the prior weighs ``1 / rho - 1`` documents.
    """
    sums = measured.groupBy(host).agg(F.count("*").alias("n"), *[F.sum(f.cast("bigint")).alias(r) for r, f in failures().items()])
    n = F.col("n").cast("double")
    prior = sums.agg(F.count("*").alias("hosts"), F.sum(n).alias("n"), F.sum(n * n).alias("n2"), *[F.sum(F.col(r).cast("double")).alias(r) for r in RULES],
                     *[F.sum(F.col(r).cast("double") * F.col(r) / n).alias(f"s_{r}") for r in RULES]).first()
    out = sums
    for r in RULES:  # one row of moments reaches the driver
        mean, rho = beta_prior(prior["hosts"], prior["n"] or 0.0, prior["n2"] or 0.0, prior[r] or 0.0, prior[f"s_{r}"] or 0.0)
        strength = max(1 / rho - 1, 0.0) if rho > 0 else 0.0
        shrunk = (F.col(r) + mean * strength) / (n + strength) if rho > 0 else F.lit(mean)
        out = out.withColumn(f"strict_{r}", shrunk > STRICT_RATE)
    return out.select(host, *[f"strict_{r}" for r in RULES])


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per document: ``key``, the measures, ``base_failed``, ``host_strict`` and ``kept``.

    A document is kept unless it fails a base rule (too short, too repetitive)
    or a rule on which its host is judged strictly (``host_strict`` lists the
    rules it fails so, null if none). Null and empty hosts are one host. Null
    keys, repeated keys and repeated rows are judged one by one; an empty table
    gives an empty result; other columns are dropped.
    """
    base = docs.select(docs[key].alias("__q_key"), F.coalesce(docs[host].cast("string"), F.lit("")).alias("__q_host"), docs[text].alias("__q_text"))
    seen = staged(measure(base, "__q_text").drop("__q_text"), "quality")  # small: no texts; used twice
    joined = _decide(seen)
    return joined.select(F.col("__q_key").alias(key), "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
                         "base_failed", F.when(F.col("strict") != "", F.col("strict")).alias("host_strict"), "kept")


def _decide(seen: DataFrame) -> DataFrame:
    """Measured rows with ``__q_host`` plus ``base_failed``, ``strict`` (rules failed on a strict host) and ``kept``."""
    hosts = staged(host_verdicts(seen, "__q_host"), "quality-hosts")
    fails = failures()
    strict = F.concat_ws(",", *[F.when(F.col(f"strict_{r}") & fails[r], F.lit(r)) for r in RULES])
    out = seen.join(sized(hosts), "__q_host").withColumns({"base_failed": fails["short"] | fails["repeats"], "strict": strict})
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("strict") == ""))


def keep_good(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their columns. The measured texts are written once and read twice."""
    whole = docs.select(F.struct("*").alias("__q_row"), F.coalesce(docs[host].cast("string"), F.lit("")).alias("__q_host"), docs[text].alias("__q_text"))
    return _decide(staged(measure(whole, "__q_text").drop("__q_text"), "quality")).where("kept").select("__q_row.*")
