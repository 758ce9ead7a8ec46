"""Readers on small files written here: quoted newlines, null markers, line
numbers, nested XML flattening."""

import os
import tempfile


from tessera.operators.flatten import flatten_xml
from tessera.sources import files as IO


def _write(text, name):
    d = tempfile.mkdtemp(prefix="tessera-src-")
    p = os.path.join(d, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_csv_quoted_newlines(spark):
    p = _write('Quality,D1,D2\n1,"line one\nline two","say ""hi"""\n0,plain,"x, y"\n', "pairs.csv")
    df = IO.read_csv(spark, p, "Quality int, D1 string, D2 string", header=True, multiline=True)
    rows = sorted(df.collect())
    assert rows[0].D1 == "plain" and rows[0].D2 == "x, y"
    assert rows[1].D1 == "line one\nline two" and rows[1].D2 == 'say "hi"'


def test_csv_null_markers(spark):
    p = _write("1,?,3.5\n2,NA,#DIV/0!\n3,7,\n", "m.csv")
    df = IO.read_csv_with_markers(spark, p, ["id", "a", "b"], {"id": "int", "a": "int", "b": "double"},
                                  ["?", "NA", "#DIV/0!"])
    got = {r.id: (r.a, r.b) for r in df.collect()}
    assert got == {1: (None, 3.5), 2: (None, None), 3: (7, None)}


def test_text_line_numbers(spark):
    p = _write("first\nsecond\n\nfourth\n", "t.txt")
    rows = IO.read_lines(spark, p).orderBy("line_no").collect()
    assert [(r.line_no, r.line) for r in rows] == [(0, "first"), (1, "second"), (2, ""), (3, "fourth")]


def test_flatten_nested_sections(spark):
    xml = ("<body><part num='1'><chapter num='a'><level num='x'>"
           "<article eId='art_1' num='1'><paragraph><content><p>Alpha  text</p></content></paragraph>"
           "<paragraph><content><blockList><listIntroduction>Items:</listIntroduction><item>one</item>"
           "<item>two</item></blockList></content></paragraph></article>"
           "<article eId='art_2' num='2'></article></level></chapter>"
           "<article eId='art_3' num='3'><paragraph><content><p>Top</p></content></paragraph></article>"
           "</part></body>")
    df = spark.createDataFrame([(xml,), ("<not xml",)], "x string")
    out = flatten_xml(df, "x").collect()
    rows = sorted(r for r in out if r.error is None)
    assert [(r.article, r.path, r.n_paragraphs, r.text) for r in rows] == [
        ("1", ["1", "a", "x"], 2, "Alpha text Items: one two"),
        ("3", ["1"], 1, "Top")]
    assert [(r.article, r.text) for r in out if r.error is not None] == [(None, None)]


def test_flatten_wrapped_namespaced_document_merges_each_text_once(spark):
    xml = ("<n:akomaNtoso xmlns:n='urn:x'><n:act><n:preface><n:p>not this</n:p></n:preface><n:body><n:title><n:num>I</n:num>"
           "<n:article eId='art_4'><n:num><n:b>Art.</n:b><n:i>4</n:i></n:num><n:paragraph><n:content><n:blockList>"
           "<n:listIntroduction>intro</n:listIntroduction><n:item><n:num>a)</n:num><n:p>x <n:i>abc</n:i></n:p></n:item>"
           "<n:item><n:blockList><n:listIntroduction>inner</n:listIntroduction><n:item>y</n:item></n:blockList></n:item>"
           "</n:blockList></n:content></n:paragraph></n:article></n:title></n:body></n:act></n:akomaNtoso>")
    r = flatten_xml(spark.createDataFrame([(xml,), (None,), ("",)], "x string"), "x").collect()
    assert [tuple(x) for x in r] == [("Art. 4", ["I"], 2, "intro x abc inner y", None)]  # a paragraph and the item with a p


def test_grid_and_arange(spark):
    g = [r.x for r in IO.grid(spark, 0.0, 1.0, 5).orderBy("i").collect()]
    assert g == [0.0, 0.25, 0.5, 0.75, 1.0]
    lg = [round(r.x, 9) for r in IO.grid(spark, -1.0, 1.0, 3, "log").orderBy("i").collect()]
    assert lg == [0.1, 1.0, 10.0]
    a = [r.x for r in IO.arange(spark, 0.0, 10.0, 2.5).orderBy("i").collect()]
    assert a == [0.0, 2.5, 5.0, 7.5]


def test_flatten_reads_all_bodies_and_counts_items(spark):
    article = "<article eId='{0}'>{1}</article>"
    para = "<paragraph><content><p>t{0}</p></content></paragraph>"
    listed = ("<paragraph><content><blockList><listIntroduction>of</listIntroduction><item><num>a)</num><p>one</p><p>more</p></item>"
              "<item><p>two</p></item><item>bare</item></blockList></content></paragraph>")
    two = f"<act><body>{article.format('a', para.format(1))}</body><x><body><part><num>P</num>{article.format('b', listed)}</part></body></x>{article.format('out', para.format(9))}</act>"
    late = f"<body><part>{article.format('c', para.format(2) + '<num>7</num>')}<num>late</num></part></body>"
    none = f"<part num='1'>{article.format('d', para.format(3))}{article.format('e', '')}</part>"
    inline = "<body><article num='f'><paragraph><content><p>a<b>b</b>c &amp; <i>d</i></p></content></paragraph></article></body>"
    bad = ["<body><article>", "<body>&undefined;</body>", "plain", f"<body>{article.format('g', para.format(4))}</body><more/>"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate([two, late, none, inline, *bad])], "k int, x string")
    out = flatten_xml(df, "x").collect()
    assert sorted((r.k, r.article, r.path, r.n_paragraphs, r.text) for r in out if r.error is None) == [
        (0, "a", [], 1, "t1"), (0, "b", ["P"], 3, "of one more two bare"), (1, "7", ["late"], 1, "t2"), (2, "d", [], 1, "t3"), (3, "f", [], 1, "a b c & d")]
    assert sorted(r.k for r in out if r.error is not None) == [4, 5, 6, 7]


def test_flatten_a_long_document(spark):
    xml = "<body>" + "".join(f"<part><num>{i}</num><article num='{i}'><paragraph><content><p>{'w ' * 50}</p></content></paragraph></article></part>" for i in range(20_000)) + "</body>"
    out = flatten_xml(spark.createDataFrame([(xml,)], "x string"), "x")
    assert out.where("error IS NULL AND path[0] = article AND length(text) = 99").count() == 20_000


def test_whole_files(spark):
    p = _write("a\r\nb\n\n", "whole.txt")
    assert [r.text for r in IO.read_whole(spark, p).collect()] == ["a\r\nb\n\n"]
