"""F rows: dates from free text, timestamps, strings, math, arrays."""

from pyspark.sql import functions as F

from tessera.functions import dates as D
from tessera.functions import scalars as S
from tessera.functions.ordering import dense_index
from tessera.plans.registry import query

# Note formats by o_orderkey % 8 (Spark pattern, DuckDB strftime pattern).
NOTE_FORMATS = [("M/d/yyyy", "%-m/%-d/%Y"), ("M/d/yy", "%-m/%-d/%y"), ("MMM d yyyy", "%b %-d %Y"),
                ("d MMMM yyyy", "%-d %B %Y"), ("MMMM d'th,' yyyy", "%B %-dth, %Y"), ("MMM yyyy", "%b %Y"),
                ("M/yyyy", "%-m/%Y"), ("yyyy", "%Y")]


def notes(t):
    """Clinical-style notes rendered from order dates (one format per order)."""
    o = t.orders.select("o_orderkey", "o_orderdate")
    k = F.col("o_orderkey") % 8
    rendered = F.coalesce(*[F.when(k == i, F.date_format("o_orderdate", f)) for i, (f, _) in enumerate(NOTE_FORMATS)])
    return o.select("o_orderkey", F.concat(F.lit("Seen on "), rendered, F.lit(" for follow-up; dose 20mg.")).alias("note"))


_NOTE_TRUTH = """(SELECT o_orderkey, CASE o_orderkey % 8
   WHEN 1 THEN TRY_CAST(printf('19%02d-%02d-%02d', year(o_orderdate) % 100, month(o_orderdate), day(o_orderdate)) AS DATE)
   WHEN 5 THEN CAST(date_trunc('month', o_orderdate) AS DATE) WHEN 6 THEN CAST(date_trunc('month', o_orderdate) AS DATE)
   WHEN 7 THEN CAST(date_trunc('year', o_orderdate) AS DATE) ELSE CAST(o_orderdate AS DATE) END AS d FROM orders)"""


@query("date_extract_cascade", f"SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS extracted FROM {_NOTE_TRUTH}")
def q_date_cascade(spark, t):
    n = notes(t)
    return n.select("o_orderkey", F.date_format(D.extract_date("note"), "yyyy-MM-dd").alias("extracted"))


@query("date_month_name", """
SELECT o_orderkey, month(o_orderdate)::INTEGER AS from_full, month(o_orderdate)::INTEGER AS from_abbrev FROM orders""")
def q_month_name(spark, t):
    o = t.orders.select("o_orderkey", F.date_format("o_orderdate", "MMMM").alias("full"),
                        F.upper(F.date_format("o_orderdate", "MMM")).alias("abbr"))
    return o.select("o_orderkey", D.month_number("full").alias("from_full"), D.month_number("abbr").alias("from_abbrev"))


@query("date_two_digit_year", """
SELECT o_orderkey, strftime(TRY_CAST(printf('19%02d-%02d-%02d', year(o_orderdate) % 100, month(o_orderdate),
       day(o_orderdate)) AS DATE), '%Y-%m-%d') AS parsed FROM orders""")
def q_two_digit(spark, t):
    o = t.orders.select("o_orderkey", F.date_format("o_orderdate", "M/d/yy").alias("txt"))
    parts = F.split("txt", "/")
    d = D._make(D.two_digit_year(parts[2]), parts[0], parts[1])
    return o.select("o_orderkey", F.date_format(d, "yyyy-MM-dd").alias("parsed"))


@query("date_chrono_order", f"""
SELECT o_orderkey, row_number() OVER (ORDER BY d NULLS FIRST, o_orderkey) - 1 AS position FROM {_NOTE_TRUTH}""")
def q_chrono(spark, t):
    n = notes(t).select("o_orderkey", D.extract_date("note").alias("d"))
    n = n.select("o_orderkey", F.col("d").isNotNull().cast("int").alias("has_d"),
                 F.coalesce("d", F.lit("0001-01-01").cast("date")).alias("d"))
    return dense_index(n, ["has_d", "d", "o_orderkey"], "position").select("o_orderkey", "position")


@query("ts_parse_ampm", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS parsed FROM events")
def q_ampm(spark, t):
    e = t.events.select("event_id", F.date_format("ts", "MM/dd/yyyy hh:mm:ss a").alias("txt"))
    return e.select("event_id", F.date_format(S.parse_ampm("txt", "MM/dd/yyyy hh:mm:ss a"),
                                              "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query("ts_duration_minutes", """
SELECT l_orderkey, l_linenumber, round((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 6e7, 6) AS minutes
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def q_duration(spark, t):
    li, o = t.lineitem, t.orders
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select("l_orderkey", "l_linenumber", F.round(S.minutes_between("o_orderdate", "l_shipdate"), 6).alias("minutes"))


@query("ts_parts", """
SELECT event_id, lower(dayname(ts)) AS weekday, lower(strftime(ts, '%b')) AS month, hour(ts) AS hour, day(ts) AS day
FROM events""")
def q_ts_parts(spark, t):
    e = t.events
    return e.select("event_id", S.weekday_name("ts").alias("weekday"), S.month_abbrev("ts").alias("month"),
                    F.hour("ts").cast("bigint").alias("hour"), F.dayofmonth("ts").cast("bigint").alias("day"))


@query("ts_day_bucket", """
SELECT event_id,
  CAST(dayofweek(ts) NOT IN (0, 6) AND (hour(ts) BETWEEN 6 AND 9 OR hour(ts) BETWEEN 16 AND 19) AS INTEGER) AS rush_hour,
  CAST(hour(ts) BETWEEN 6 AND 9 AS INTEGER) AS am_rush, CAST(hour(ts) BETWEEN 10 AND 15 AS INTEGER) AS daytime,
  CAST(hour(ts) BETWEEN 16 AND 19 AS INTEGER) AS pm_rush, CAST(hour(ts) >= 20 OR hour(ts) <= 5 AS INTEGER) AS nighttime
FROM events""")
def q_day_bucket(spark, t):
    e = t.events
    flags = S.day_part_flags("ts")
    return e.select("event_id", S.rush_hour("ts").alias("rush_hour"), *[v.alias(k) for k, v in flags.items()])


@query("str_length", """
SELECT quality, round(avg(length(text)), 6) AS mean_len, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY quality""")
def q_str_length(spark, t):
    j = t.documents.join(t.labels, "doc_id")
    return j.groupBy("quality").agg(F.round(F.avg(F.length("text")), 6).alias("mean_len"), F.count(F.lit(1)).alias("n"))


@query("str_regex_count", """
SELECT quality, round(avg(length(regexp_replace(text, '[^0-9]', '', 'g'))), 6) AS mean_digits,
       round(avg(length(regexp_replace(text, '[a-zA-Z0-9_]', '', 'g'))), 6) AS mean_non_word
FROM documents JOIN labels USING (doc_id) GROUP BY quality""")
def q_regex_count(spark, t):
    j = t.documents.join(t.labels, "doc_id")
    return j.groupBy("quality").agg(F.round(F.avg(S.count_digits("text")), 6).alias("mean_digits"),
                                    F.round(F.avg(S.count_non_word("text")), 6).alias("mean_non_word"))


@query("str_predicates", """
SELECT p_partkey, starts_with(p_name, 'b') AS starts_b, regexp_full_match(p_name, '\\p{L}+') AS name_alpha,
       regexp_full_match(split_part(p_name, ' ', 1), '\\p{L}+') AS first_word_alpha FROM part""")
def q_predicates(spark, t):
    p = t.part
    return p.select("p_partkey", F.col("p_name").startswith("b").alias("starts_b"), S.is_alpha("p_name").alias("name_alpha"),
                    S.is_alpha(F.split("p_name", " ")[0]).alias("first_word_alpha"))


@query("str_replace_chain", """
SELECT conv_id, turn, md5(trim(replace(replace(replace(text, chr(10), ' '), chr(9), ' '), '  ', ' '))) AS clean_md5,
       'https://example.org/c/' || conv_id || '#' || turn AS link FROM conversations""")
def q_replace_chain(spark, t):
    c = t.conversations
    clean = F.trim(F.replace(F.replace(F.replace("text", F.lit("\n"), F.lit(" ")), F.lit("\t"), F.lit(" ")),
                             F.lit("  "), F.lit(" ")))
    link = F.concat(F.lit("https://example.org/c/"), F.col("conv_id").cast("string"), F.lit("#"), F.col("turn").cast("string"))
    return c.select("conv_id", "turn", F.md5(clean).alias("clean_md5"), link.alias("link"))


@query("math_round_log", """
SELECT lang, round(ln(p / (1 - p)), 6) AS log_odds, round(p, 2) AS rate_2dp FROM
  (SELECT lang, avg(CAST(quality = 1 AS DOUBLE)) AS p FROM documents JOIN labels USING (doc_id) GROUP BY lang)
WHERE p > 0 AND p < 1""")
def q_round_log(spark, t):
    j = t.documents.join(t.labels, "doc_id").groupBy("lang").agg(F.avg((F.col("quality") == 1).cast("double")).alias("p"))
    j = j.where((F.col("p") > 0) & (F.col("p") < 1))
    return j.select("lang", F.round(S.log_odds("p"), 6).alias("log_odds"), F.round("p", 2).alias("rate_2dp"))


@query("math_nearest", """
SELECT arg_min(o_orderkey, (abs(o_totalprice - 250000), o_orderkey)) AS o_orderkey,
       round(min(abs(o_totalprice - 250000)), 6) AS gap FROM orders""")
def q_nearest(spark, t):
    o = t.orders.withColumn("gap", F.abs(F.col("o_totalprice") - 250000))
    return o.agg(F.min_by("o_orderkey", F.struct("gap", "o_orderkey")).alias("o_orderkey"),
                 F.round(F.min("gap"), 6).alias("gap"))


@query("arr_path_append", """
SELECT c_custkey, r_name || '/' || n_name || '/' || c_name AS path, 3 AS depth
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def q_path_append(spark, t):
    r = t.region.select("r_regionkey", F.array("r_name").alias("path"))
    n = t.nation.join(r, t.nation.n_regionkey == r.r_regionkey).select(
        "n_nationkey", F.concat("path", F.array("n_name")).alias("path"))
    c = t.customer.join(n, t.customer.c_nationkey == n.n_nationkey).select(
        "c_custkey", F.concat("path", F.array("c_name")).alias("path"))
    return c.select("c_custkey", F.array_join("path", "/").alias("path"), F.size("path").alias("depth"))
