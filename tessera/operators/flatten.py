"""Document flattening (X rows).

X1: an XML statute-like tree (part / title / chapter / level / section, with
optional block lists) becomes one row per article: ``(article, section path,
paragraph count, merged text)``; articles without paragraphs are dropped.
Namespaces are ignored and the tree may be wrapped: all ``body`` elements are
read, or the root where there is none. The number of a section or article is its
``num`` child, else its ``num`` attribute, else its ``eId``. List items that hold
their text in a ``p`` count as paragraphs too. Every text is merged once, in
document order. A document that is no XML yields one row that holds only
``error``.

Documents are read as a stream of parser events in one pass, so a long one is
never a tree in memory: what is kept is the open elements and the articles found.
The parser resolves no external entities. Rows come and go in Arrow batches.

X2: nested JSON notes become flat typed rows with ``from_json`` + ``explode``.
"""

from __future__ import annotations

from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import ship_package

# The element names of the document format.
SECTION_TAGS = ("part", "title", "chapter", "level", "section")
#: Elements whose text is merged as one piece; an item counts only where it holds none of the others.
TEXT_TAGS = ("p", "listIntroduction", "item")
_FEED = 1 << 16


class _Numbered:
    """A section or article with its number, which may come after its first content."""

    def __init__(self, attributes: dict):
        self.attribute, self.child = attributes.get("num") or attributes.get("eId") or "", None

    @property
    def number(self) -> str:
        return self.attribute if self.child is None else self.child


class Articles:
    """Events of one document: ``found`` gets (in a body, sections, article, paragraphs, pieces)."""

    def __init__(self):
        self.found, self.open = [], []  # open: [tag, role, holder]
        self.bodies = 0
        self.number = None  # depth and text of the num element being read
        self.pieces = []  # open text elements: [depth, tag, parts, holds another]
        self.article = None

    def start(self, name: str, attributes: dict) -> None:
        tag = name.rpartition("}")[2]
        self.text(" ")  # elements side by side are words apart
        parent = self.open[-1] if self.open else None
        role = holder = None
        if tag == "body" and self.article is None:
            role = "container"
            self.bodies += 1
        elif parent is None:
            role = "container"
        elif parent[1] in ("container", "section") and tag in SECTION_TAGS:
            role, holder = "section", _Numbered(attributes)
        elif parent[1] in ("container", "section") and tag == "article":
            role, holder = "article", _Numbered(attributes)
            sections = [h for _, r, h in self.open if r == "section"]
            self.article = [any(t == "body" for t, _, _ in self.open), sections, holder, 0, []]
        elif parent[1] == "article" and tag == "paragraph":
            role = "paragraph"
            self.article[3] += 1
        elif tag == "num" and parent[1] in ("section", "article") and parent[2].child is None and self.number is None:
            self.number = [len(self.open), []]
        elif any(r == "paragraph" for _, r, _ in self.open):
            if tag == "p" and parent[0] == "item" and not parent[2].get("p"):
                parent[2]["p"] = True
                self.article[3] += 1
            if tag in TEXT_TAGS and (not self.pieces or self.pieces[-1][1] == "item"):
                for piece in self.pieces:
                    piece[3] = True
                self.pieces.append([len(self.open), tag, [], False])
        self.open.append([tag, role, {} if tag == "item" else holder])

    def end(self, name: str) -> None:
        tag, role, holder = self.open.pop()
        depth = len(self.open)
        if self.number and self.number[0] == depth:
            self.open[-1][2].child = " ".join("".join(self.number[1]).split())
            self.number = None
        if self.pieces and self.pieces[-1][0] == depth:
            _, _, parts, other = self.pieces.pop()
            text = " ".join("".join(parts).split())
            if text and not other:
                self.article[4].append(text)
        if role == "article":
            if self.article[3]:
                self.found.append(self.article)
            self.article = None
        self.text(" ")

    def text(self, data: str) -> None:
        if self.number:
            self.number[1].append(data)
        elif self.pieces:
            self.pieces[-1][2].append(data)

    def rows(self) -> list[tuple]:
        return [(a.number, [s.number for s in sections], n, " ".join(pieces), None)
                for inside, sections, a, n, pieces in self.found if inside or not self.bodies]


def articles_of(xml: str) -> list[tuple]:
    """``(article, path, n_paragraphs, text, error)`` rows of one document."""
    seen = Articles()
    parser = expat.ParserCreate(namespace_separator="}")
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = seen.start, seen.end, seen.text
    try:
        for at in range(0, len(xml), _FEED):
            parser.Parse(xml[at:at + _FEED], False)
        parser.Parse("", True)
    except expat.ExpatError as e:
        return [(None, None, None, None, str(e))]
    return seen.rows()


def flatten_xml(df: DataFrame, xml_col: str) -> DataFrame:
    """The other columns of ``df`` with a row per article; null and empty documents have none."""
    keep = [f for f in df.schema if f.name != xml_col]
    kinds = {"article": pa.string(), "path": pa.list_(pa.string()), "n_paragraphs": pa.int32(), "text": pa.string(), "error": pa.string()}
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep] + ["article string, path array<string>, n_paragraphs int, text string, error string"])
    names = [f.name for f in keep]

    def run(batches):
        for b in batches:
            at, rows = [], []
            for i, xml in enumerate(b.column(b.num_columns - 1)):
                found = articles_of(xml.as_py()) if xml.is_valid and len(xml.as_py()) else []
                at += [i] * len(found)
                rows += found
            if rows:
                take = pa.array(at, pa.int32())
                yield pa.RecordBatch.from_arrays([b.column(i).take(take) for i in range(len(names))] + [pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())],
                                                 [*names, *kinds])

    ship_package(df.sparkSession)
    return df.select(*[F.col(f"`{n}`") for n in names], F.col(xml_col)).mapInArrow(run, schema)


NOTES_SCHEMA = ("notes array<struct<content: struct<title: struct<value: string>, "
                "keywords: struct<value: array<string>>, authors: struct<value: array<string>>, "
                "abstract: struct<value: string>, pdf: struct<value: string>>>>")


def flatten_notes(df: DataFrame, json_col: str, url_prefix: str) -> DataFrame:
    """``(title, keywords[], authors[], abstract, link)`` per note."""
    parsed = df.withColumn("__n", F.from_json(F.col(json_col), NOTES_SCHEMA)).drop(json_col)
    keep = [c for c in parsed.columns if c != "__n"]
    ex = parsed.select(*keep, F.explode("__n.notes").alias("note"))
    c = F.col("note.content")
    return ex.select(*keep, c["title"]["value"].alias("title"), c["keywords"]["value"].alias("keywords"),
                     c["authors"]["value"].alias("authors"), c["abstract"]["value"].alias("abstract"),
                     F.concat(F.lit(url_prefix), c["pdf"]["value"]).alias("link"))
