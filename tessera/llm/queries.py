"""The operators of this package over the test tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, chat, fingerprints, html, merkle, minhash, mixing, pii, quality, secrets, suffix_dedup, warc, whitening
from tessera.llm.common import table

BPE_FILE = "word_bpe_49k.json"


def tokenizer_path(name: str = BPE_FILE) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


def op1_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = pii.detect(table(spark, sf_dir, "documents"), ["doc_id"])
    base = F.filter("spans", lambda x: x["base"])
    return got.select("doc_id", *[_count(base, k) for k in pii.BASE],
                      F.sha2(pii.spell(base).cast("binary"), 256).alias("base_sha256"), pii.spell(F.col("spans")).alias("spans"))


def op2_raked_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = mixing.sample(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "source", "lang", F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("n_tokens"),
                      F.round("mix_p", 4).alias("probability"), F.col("mix_kept").alias("kept"))


def op3_repeat_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path())
    return got.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op5_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.link(table(spark, sf_dir, "conversations"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


def op7_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("n_lines")


def op8_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op9_grammar_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = secrets.detect(table(spark, sf_dir, "documents"), ["doc_id"])
    base = F.filter("spans", lambda x: x["kind"] != "format")
    return got.select("doc_id", *[_count(base, k) for k in secrets.BASE],
                      F.sha2(pii.spell(base).cast("binary"), 256).alias("base_sha256"), pii.spell(F.col("spans")).alias("spans"))


def op10_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


#: Pages carry no capture time: a page is taken as captured its id (modulo a year) in seconds after this.
CAPTURED_FROM, YEAR_SECONDS = 1_704_067_200, 31_536_000


def op11_loser_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.lit(CAPTURED_FROM) + F.coalesce(F.pmod("page_id", F.lit(YEAR_SECONDS)), F.lit(0))
    archives = warc.write(table(spark, sf_dir, "pages"), "page_id", "url", "html", seconds)
    return warc.history(warc.read(archives)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "position", "nth")


def op12_lanczos_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_slot_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0
    return merkle.manifest(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id",
                           {"text": F.when(tampered, merkle.lower_ascii(F.col("text"))).otherwise(F.col("text"))})


QUERIES = {f.__name__: f for f in (
    op1_weak_supervision, op2_raked_mix, op3_repeat_intervals, op4_bpe_automaton, op5_quotation_links,
    op6_main_text, op7_host_quality, op8_odd_sketches, op9_grammar_secrets, op10_weighted_sampling, op11_loser_tree,
    op12_lanczos_whitening, op13_slot_pivot)}

_FAIL = {
    "short": f"n_words < {quality.MIN_WORDS}",
    "repeats": f"100 * n_repeat_words > {quality.MAX_REPEAT_PCT} * n_words",
    "symbols": f"100 * n_symbols > {quality.MAX_SYMBOL_PCT} * word_chars",
    "dup_lines": f"100 * n_dup_lines > {quality.MAX_DUP_LINE_PCT} * n_lines",
    "long_words": f"word_chars > {quality.MAX_MEAN_WORD} * n_words",
}


def quality_sql(source: str = "documents") -> str:
    """The measures, host verdicts and decisions of ``op7`` as SQL over a table of documents."""
    sums = ", ".join(f"CAST(sum(CASE WHEN {c} THEN 1 ELSE 0 END) AS DOUBLE) AS f_{r}" for r, c in _FAIL.items())
    prior = ", ".join(f"sum(f_{r}) / sum(n) AS m_{r}, sum(f_{r} * f_{r} / n) - sum(f_{r}) * sum(f_{r}) / sum(n) AS s_{r}" for r in _FAIL)
    rho = ", ".join(f"CASE WHEN m_{r} * (1 - m_{r}) <= 0 OR room <= 1e-9 THEN 0 ELSE (s_{r} / (m_{r} * (1 - m_{r})) - (k - 1)) / room END AS rho_{r}" for r in _FAIL)
    strict = ", ".join(
        f"(CASE WHEN rho_{r} > 0 THEN (f_{r} + m_{r} * greatest(1 / rho_{r} - 1, 0)) / (n + greatest(1 / rho_{r} - 1, 0)) ELSE m_{r} END > {quality.STRICT_RATE}) AS strict_{r}"
        for r in _FAIL)
    why = "concat_ws(',', " + ", ".join(f"CASE WHEN strict_{r} AND {c} THEN '{r}' END" for r, c in _FAIL.items()) + ")"
    return f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM {source}),
w AS (SELECT rid, doc_id, host, text, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM t),
win AS (SELECT rid, i, array_to_string(ws[i:i+7], ' ') AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT rid, sum(least(8, coalesce(nxt - i, 8))) AS n FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM dup) GROUP BY rid),
m AS (SELECT w.rid, doc_id, host, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) AS BIGINT) AS n_lines,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN rep ON w.rid = rep.rid),
h AS (SELECT host, CAST(count(*) AS DOUBLE) AS n, {sums} FROM m GROUP BY host),
q AS (SELECT count(*) AS k, sum(n) - sum(n * n) / sum(n) - (count(*) - 1) AS room, {prior} FROM h),
p AS (SELECT *, {rho} FROM q),
v AS (SELECT host, {strict} FROM h, p),
j AS (SELECT m.*, ({_FAIL['short']} OR {_FAIL['repeats']}) AS base_failed, {why} AS why FROM m JOIN v ON m.host = v.host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, nullif(why, '') AS host_strict,
       (NOT base_failed AND why = '') AS kept FROM j"""


def mixing_sql(source: str = "documents", seed: int = 7) -> str:
    """Cells, raking, probabilities and draws of ``op2`` as SQL."""
    topics = " ".join(f"WHEN contains(text, '{mark}') THEN '{name}'" for name, mark in mixing.TOPICS)
    margin = ", ".join(f"pow(CAST(sum(n) OVER (PARTITION BY {m}) AS DOUBLE), {mixing.FLATTEN}) AS r_{m}, count(*) OVER (PARTITION BY {m}) AS c_{m}" for m in mixing.MARGINS)
    scaled = ", ".join(f"r_{m} / sum(r_{m} / c_{m}) OVER () AS t_{m}" for m in mixing.MARGINS)
    steps, last = [], "c3"
    for i in range(mixing.ROUNDS):
        for m in mixing.MARGINS:
            steps.append(f"s{i}_{m} AS (SELECT * REPLACE (w * t_{m} / sum(w) OVER (PARTITION BY {m}) AS w) FROM {last})")
            last = f"s{i}_{m}"
    return f"""
WITH d AS (SELECT doc_id, source, lang, coalesce(source, '') AS s, coalesce(lang, '') AS l, coalesce(CASE {topics} END, '{mixing.REST}') AS topic,
                  CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS BIGINT) AS n FROM {source}),
c1 AS (SELECT s AS source, l AS lang, topic, sum(n) AS n FROM d GROUP BY ALL HAVING sum(n) > 0),
c2 AS (SELECT *, {margin} FROM c1),
c3 AS (SELECT source, lang, topic, n, CAST(n AS DOUBLE) AS w, {scaled} FROM c2),
{", ".join(steps)},
p AS (SELECT source, lang, topic, w / n / max(w / n) OVER () AS p FROM {last}),
j AS (SELECT d.*, CASE WHEN d.n > 0 THEN p.p ELSE 1.0 END AS p,
             (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':{seed}'), 1, 8) AS BIGINT) + 0.5) / 4294967296.0 AS u
      FROM d LEFT JOIN p ON d.s = p.source AND d.l = p.lang AND d.topic = p.topic)
SELECT doc_id, source, lang, topic, n AS n_tokens, round(p, 4) AS probability, u < p AS kept FROM j"""


def warc_sql() -> str:
    """Record types and ordered histories of ``op11``; for URLs of a scheme and a host."""
    host = "string_split(lower(regexp_replace(regexp_replace(regexp_extract(url, '://([^/?#]*)', 1), '^.*@', ''), ':.*$', '')), '.')"
    tail = "regexp_replace(regexp_replace(url, '^[^:]+://[^/?#]*', ''), '#.*$', '')"
    return f"""
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
             {host} AS host, {tail} AS tail,
             strftime(to_timestamp({CAPTURED_FROM} + page_id % {YEAR_SECONDS}) AT TIME ZONE 'UTC', '%Y%m%d%H%M%S') AS captured FROM pages),
k AS (SELECT *, array_to_string(list_reverse(CASE WHEN len(host) > 2 AND host[1] = 'www' THEN host[2:] ELSE host END), ',') || ')'
             || lower(CASE WHEN tail LIKE '/%' THEN tail ELSE '/' || tail END) AS url_key,
             min(page_id) OVER (PARTITION BY payload_digest) AS original FROM p),
r AS (SELECT *, CASE WHEN payload_bytes >= {warc.SHORTEST} AND page_id <> original THEN original END AS refers_to FROM k)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to, url_key, captured,
       row_number() OVER (ORDER BY url_key, captured, page_id) - 1 AS position, row_number() OVER (PARTITION BY url_key ORDER BY captured, page_id) AS nth FROM r"""


def _field_sql(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE CAST(octet_length(encode({text})) AS VARCHAR) || ':' || {text} END"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree_sql(name: str, start: str, levels: int) -> str:
    """CTEs ``{name}0`` to ``{name}{levels}``: the nodes (g, pos, n, d, l, r) of each level with their siblings' texts."""
    around = ("CASE WHEN n = 1 THEN NULL ELSE coalesce(string_agg(d, '') OVER (PARTITION BY g, pos // 8 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS l, "
              "CASE WHEN n = 1 THEN NULL ELSE coalesce(string_agg(d, '') OVER (PARTITION BY g, pos // 8 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS r")
    steps = [f"{name}0 AS (SELECT *, {around} FROM ({start}))"]
    for k in range(1, levels + 1):
        steps.append(f"{name}{k} AS (SELECT *, {around} FROM (SELECT g, pos // 8 AS pos, CASE WHEN any_value(n) = 1 THEN 1 ELSE (any_value(n) + 7) // 8 END AS n, "
                     f"CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY pos)) END AS d FROM {name}{k - 1} GROUP BY g, pos // 8))")
    return ", ".join(steps)


def merkle_sql(levels: int = 8, group_levels: int = 3) -> str:
    """Tree, proofs and folded roots of ``op13``, for up to 8^levels rows in 8^group_levels languages."""
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), "
           "lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::BIGINT)")
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    at = [f"t{k}.g = t.g AND t{k}.pos = t.pos // {8 ** k}" for k in range(levels)]
    up = [f"u{k}.pos = (t.g - 1) // {8 ** k}" for k in range(group_levels)]
    proof = " || ".join([f"coalesce(t{k}.l || t{k}.r, '')" for k in range(levels)] + [f"coalesce(u{k}.l || u{k}.r, '')" for k in range(group_levels)])
    folds, last = [], "f0 AS (SELECT *, claim AS f FROM p)"
    for k, side in enumerate([f"t{i}" for i in range(levels)] + [f"u{i}" for i in range(group_levels)], 1):
        folds.append(f"f{k} AS (SELECT * REPLACE (CASE WHEN {side}_l IS NULL THEN f ELSE sha256({side}_l || f || {side}_r) END AS f) FROM f{k - 1})")
    sides = ", ".join([f"t{k}.l AS t{k}_l, t{k}.r AS t{k}_r" for k in range(levels)] + [f"u{k}.l AS u{k}_l, u{k}.r AS u{k}_r" for k in range(group_levels)])
    return f"""
WITH x AS (SELECT doc_id, lang, {_leaf_sql('text')} AS leaf, {_leaf_sql(f'CASE WHEN ({crc}) % 3 = 0 THEN {lower} ELSE text END')} AS claim FROM documents),
y AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, claim) - 1 AS pos,
             count(*) OVER (PARTITION BY lang) AS n FROM x),
{_tree_sql('t', 'SELECT g, pos, n, leaf AS d FROM y', levels)},
{_tree_sql('u', f'SELECT 0 AS g, g - 1 AS pos, count(*) OVER () AS n, d FROM t{levels}', group_levels)},
p AS (SELECT t.doc_id, t.leaf, t.claim, s.d AS subroot, w.d AS root, sha256({proof}) AS proof_sha256, {sides}
      FROM y t JOIN t{levels} s ON s.g = t.g JOIN u{group_levels} w ON true
      {' '.join(f'JOIN t{k} ON {c}' for k, c in enumerate(at))} {' '.join(f'JOIN u{k} ON {c}' for k, c in enumerate(up))}),
{last}, {", ".join(folds)}
SELECT doc_id, leaf, subroot, root, proof_sha256, f AS folded_root, f = root AS verified FROM f{levels + group_levels}"""


ORACLES = {"op7_host_quality": quality_sql(), "op2_raked_mix": mixing_sql(), "op11_loser_tree": warc_sql(),
           "op13_slot_pivot": merkle_sql()}
