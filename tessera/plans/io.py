"""S, K and X rows: file formats round-tripped through the shared scratch folder,
and document flattening. Each query writes its input file from a test table
(a Spark write, no driver-side data), then returns the lazy read."""

from pyspark.sql import functions as F

from tessera.operators.flatten import flatten_notes, flatten_xml
from tessera.plans.registry import query, scratch_dir
from tessera.sources import files as IO


@query("src_csv", "SELECT * FROM customer")
def q_src_csv(spark, t):
    path = scratch_dir(spark, "customer-csv")
    t.customer.write.option("header", True).option("escape", '"').csv(path)
    schema = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return IO.read_csv(spark, path, schema, header=True)


@query("src_csv_multiline", "SELECT doc_id, lang, n_chars, md5(text) AS text_md5 FROM documents")
def q_src_csv_multiline(spark, t):
    """Texts with line breaks, quotes and commas inside the fields: only such files are read whole, a task each."""
    path = scratch_dir(spark, "documents-csv")
    t.documents.select("doc_id", "lang", "n_chars", "text").write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    back = IO.read_csv(spark, path, "doc_id long, lang string, n_chars long, text string", header=True, multiline=True)
    return back.select("doc_id", "lang", "n_chars", F.md5("text").alias("text_md5"))


@query("src_csv_nulls", """
SELECT s_suppkey, s_name, s_nationkey, CASE WHEN s_acctbal < 0 THEN NULL ELSE s_acctbal END AS s_acctbal FROM supplier""")
def q_src_csv_nulls(spark, t):
    path = scratch_dir(spark, "supplier-csv")
    s = t.supplier.select(F.col("s_suppkey").cast("string"), "s_name", F.col("s_nationkey").cast("string"),
                          F.when(F.col("s_acctbal") < 0, F.lit("?")).otherwise(F.col("s_acctbal").cast("string")))
    s.write.option("header", False).csv(path)
    names = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]
    return IO.read_csv_with_markers(spark, path, names, {"s_suppkey": "bigint", "s_nationkey": "int",
                                                         "s_acctbal": "double"}, ["?", "NA", "#DIV/0!"])


@query("src_text_lines", """
SELECT row_number() OVER (ORDER BY item_id, pos) - 1 AS line_no, line FROM
  (SELECT item_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
   FROM benchmark)""")
def q_src_text(spark, t):
    path = scratch_dir(spark, "benchmark-text")
    # range-partitioned by item: file name order = item order
    t.benchmark.repartitionByRange(4, "item_id").sortWithinPartitions("item_id").select("text").write.text(path)
    return IO.read_lines(spark, path)


@query("src_text_whole", """
SELECT item_id % 8 AS part, count(*) AS n_lines, CAST(length(string_agg(text, chr(10) ORDER BY item_id)) + 1 AS INTEGER) AS n_chars,
       md5(string_agg(text, chr(10) ORDER BY item_id) || chr(10)) AS text_md5
FROM (SELECT item_id, unnest(string_split(text, chr(10))) AS text FROM benchmark) GROUP BY 1""")
def q_src_text_whole(spark, t):
    """Files as one text each, with the number of their lines."""
    path = scratch_dir(spark, "benchmark-files")
    parts = t.benchmark.select("item_id", (F.col("item_id") % 8).alias("part"), "text")
    parts.repartition("part").sortWithinPartitions("part", "item_id").select("part", "text").write.partitionBy("part").text(path)
    whole = IO.read_whole(spark, path)
    return whole.select(F.regexp_extract("file", "part=([0-9]+)/", 1).cast("bigint").alias("part"), F.regexp_count("text", F.lit("\n")).cast("bigint").alias("n_lines"),
                        F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


@query("src_json_nested", """
SELECT conv_id, turn, role, len(string_split(text, ' ')) AS n_words, string_split(text, ' ')[1] AS first_word
FROM conversations""")
def q_src_json(spark, t):
    path = scratch_dir(spark, "conversations-json")
    c = t.conversations.select(F.struct(F.col("conv_id").alias("id"), F.col("turn").alias("turn")).alias("conv"),
                               "role", F.split("text", " ").alias("words"))
    c.write.json(path)
    schema = "conv struct<id: long, turn: long>, role string, words array<string>"
    r = IO.read_json(spark, path, schema)
    return r.select(F.col("conv.id").alias("conv_id"), F.col("conv.turn").alias("turn"), "role",
                    F.size("words").cast("bigint").alias("n_words"), F.col("words")[0].alias("first_word"))


@query("src_xml", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def q_src_xml(spark, t):
    path = scratch_dir(spark, "lineitem-xml")
    li = t.lineitem.select(F.col("l_orderkey").alias("_order"), F.col("l_linenumber").alias("_n"),
                           F.col("l_quantity").alias("qty"), F.col("l_returnflag").alias("flag"))
    IO.write_xml(li, path, "lines", "line")
    r = IO.read_xml(spark, path, "line", "_order long, _n int, qty double, flag string")
    return r.select(F.col("_order").alias("l_orderkey"), F.col("_n").alias("l_linenumber"),
                    F.col("qty").alias("l_quantity"), F.col("flag").alias("l_returnflag"))


@query("src_tsv_lexicon", """
SELECT n_nationkey, n_name, n_regionkey, string_split(n_name, ' ')[1] AS first_word FROM nation""")
def q_src_tsv(spark, t):
    path = scratch_dir(spark, "nation-tsv")
    body = t.nation.select(F.concat_ws("\t", F.col("n_nationkey").cast("string"), "n_name",
                                       F.col("n_regionkey").cast("string")).alias("v"))
    head = spark.range(1).select(F.lit("# nation lexicon: key, name, region").alias("v"))
    head.unionByName(body).write.text(path)
    r = IO.read_csv(spark, path, "n_nationkey int, n_name string, n_regionkey int", header=False, sep="\t", comment="#")
    return r.withColumn("first_word", F.split("n_name", " ")[0])


@query("src_grid", """
WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
l AS (SELECT min(log10(l_extendedprice)) AS lo, max(log10(l_extendedprice)) AS hi FROM lineitem)
SELECT 'linspace' AS kind, range AS i, round(lo + range * (hi - lo) / 10, 6) AS x FROM range(11), s
UNION ALL SELECT 'logspace', range, round(pow(10, lo + range * (hi - lo) / 4), 6) FROM range(5), l
UNION ALL SELECT 'arange', range, round(lo + range * 100000.0, 6) FROM range(100000), s WHERE range < ceil((hi - lo) / 100000.0)""")
def q_src_grid(spark, t):
    from tessera.functions.subquery import scalar_row
    s = scalar_row(t.orders.agg(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi")))
    lg = scalar_row(t.lineitem.agg(F.min(F.log10("l_extendedprice")).alias("lo"),
                                   F.max(F.log10("l_extendedprice")).alias("hi")))
    a = IO.grid(spark, s["lo"], s["hi"], 11).withColumn("kind", F.lit("linspace"))
    b = IO.grid(spark, lg["lo"], lg["hi"], 5, "log").withColumn("kind", F.lit("logspace"))
    c = IO.arange(spark, s["lo"], s["hi"], 100000.0).withColumn("kind", F.lit("arange"))
    return IO.union_all([a, b, c]).select("kind", "i", F.round("x", 6).alias("x"))


@query("src_values", """
SELECT v.obs, v.nationkey, n_name, v.balance FROM (VALUES (1, 3, 100.5::DOUBLE), (2, 7, -20.0::DOUBLE), (3, 99, 0.0::DOUBLE)) v(obs, nationkey, balance)
LEFT JOIN nation ON n_nationkey = v.nationkey""")
def q_src_values(spark, t):
    v = spark.createDataFrame([(1, 3, 100.5), (2, 7, -20.0), (3, 99, 0.0)], "obs int, nationkey int, balance double")
    return v.join(t.nation, v.nationkey == t.nation.n_nationkey, "left").select("obs", "nationkey", "n_name", "balance")


@query("sink_csv", """
SELECT l_orderkey, l_linenumber, l_returnflag || ',' || l_linestatus AS flags FROM lineitem""")
def q_sink_csv(spark, t):
    path = scratch_dir(spark, "sink-csv")
    li = t.lineitem.select("l_orderkey", "l_linenumber", F.array("l_returnflag", "l_linestatus").alias("flags"))
    IO.write_csv(li, path, sep=";")
    r = IO.read_csv(spark, path, "l_orderkey long, l_linenumber int, flags string", header=True, sep=";")
    return r.select("l_orderkey", "l_linenumber",
                    F.array_join(F.from_json("flags", "array<string>"), ",").alias("flags"))


@query("sink_json", """
SELECT o_orderkey, o_orderstatus || '|' || o_orderpriority AS tags, o_totalprice FROM orders""")
def q_sink_json(spark, t):
    path = scratch_dir(spark, "sink-json")
    o = t.orders.select("o_orderkey", F.array("o_orderstatus", "o_orderpriority").alias("tags"), "o_totalprice")
    IO.write_json(o, path)
    r = IO.read_json(spark, path, "o_orderkey long, tags array<string>, o_totalprice double")
    return r.select("o_orderkey", F.array_join("tags", "|").alias("tags"), "o_totalprice")


def _statute_xml(t):
    """One statute-like document per customer: part = region, chapter = nation,
    article = customer; customers with a negative balance have no paragraphs.
    Even keys come wrapped, with a namespace, numbers as elements and paragraphs
    in the items; the others bare, with attributes. Each tenth key is cut off;
    each fifth even key has its article in a second body."""
    c = t.customer.join(t.nation, t.customer.c_nationkey == t.nation.n_nationkey).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    full = F.col("c_custkey") % 2 == 0

    def paras(item):
        return F.when(F.col("c_acctbal") >= 0, F.format_string(
            "<paragraph><content><p>%s</p></content></paragraph><paragraph><content><blockList>"
            f"<listIntroduction>balance</listIntroduction><item>{item}</item></blockList></content></paragraph>",
            "c_mktsegment", F.floor("c_acctbal").cast("long"))).otherwise(F.lit(""))

    wrapped = F.format_string(
        "<a:akomaNtoso xmlns:a=\"urn:a\" xmlns=\"urn:a\"><act><meta/>%s<body><part><num>%s</num><chapter><num>%s</num>"
        "<article eId=\"art_%d\"><num><b>%d</b></num>%s</article></chapter></part></body></act></a:akomaNtoso>",
        F.when(F.col("c_custkey") % 5 == 1, "<body><part><num>empty</num></part></body>").otherwise(""),
        "r_name", "n_name", "c_custkey", "c_custkey", paras("<num>a)</num><p>%d</p>"))
    bare = F.format_string("<body><part num=\"%s\"><chapter num=\"%s\"><article eId=\"art_%d\" num=\"%d\">%s</article>"
                           "</chapter></part></body>", "r_name", "n_name", "c_custkey", "c_custkey", paras("%d"))
    xml = F.when(F.col("c_custkey") % 10 == 0, F.expr("substring(xml, 1, length(xml) - 9)")).otherwise(F.col("xml"))
    return c.withColumn("xml", F.when(full, wrapped).otherwise(bare)).select("c_custkey", xml.alias("xml"))


@query("doc_flatten_xml", """
SELECT c_custkey, CASE WHEN ok THEN CAST(c_custkey AS VARCHAR) END AS article, CASE WHEN ok THEN r_name || '/' || n_name END AS path,
       CASE WHEN ok THEN CASE WHEN c_custkey % 2 = 0 THEN 3 ELSE 2 END END AS n_paragraphs,
       CASE WHEN ok THEN c_mktsegment || ' balance ' || CAST(floor(c_acctbal) AS BIGINT) END AS text, NOT ok AS malformed
FROM (SELECT *, c_custkey % 10 <> 0 AS ok FROM customer) JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE c_acctbal >= 0 OR NOT ok""")
def q_flatten_xml(spark, t):
    f = flatten_xml(_statute_xml(t), "xml")
    return f.select("c_custkey", "article", F.array_join("path", "/").alias("path"), "n_paragraphs", "text",
                    F.col("error").isNotNull().alias("malformed"))


@query("doc_flatten_json", """
SELECT conv_id, turn, array_to_string(list_slice(string_split(text, ' '), 1, 5), ' ') AS title,
  array_to_string(list_slice(string_split(text, ' '), 1, 3), ';') AS keywords, role AS authors, md5(text) AS abstract_md5,
  'https://example.org/pdf/' || conv_id || '-' || turn AS link FROM conversations""")
def q_flatten_json(spark, t):
    c = t.conversations
    words = F.split("text", " ")
    note = F.struct(F.struct(
        F.struct(F.array_join(F.slice(words, 1, 5), " ").alias("value")).alias("title"),
        F.struct(F.slice(words, 1, 3).alias("value")).alias("keywords"),
        F.struct(F.array("role").alias("value")).alias("authors"),
        F.struct(F.col("text").alias("value")).alias("abstract"),
        F.struct(F.format_string("/pdf/%d-%d", "conv_id", "turn").alias("value")).alias("pdf")).alias("content"))
    packed = c.select("conv_id", "turn", F.to_json(F.struct(F.array(note).alias("notes"))).alias("js"))
    f = flatten_notes(packed, "js", "https://example.org")
    return f.select("conv_id", "turn", "title", F.array_join("keywords", ";").alias("keywords"),
                    F.array_join("authors", ";").alias("authors"), F.md5("abstract").alias("abstract_md5"), "link")
