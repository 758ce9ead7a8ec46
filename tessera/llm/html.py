"""Main text of web pages: flat text blocks and a decision tree.

A page is cut into a flat list of text blocks (the text between block-level
tags). Each block has its word count and link density, those of the blocks
before and after it, and the kind of the elements around it. A decision tree,
grown by Gini impurity on a small labelled table of blocks, says which blocks
are article text.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import arrow_map, schema_of, slices

# Element names of HTML by what they do to text.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
SILENT = frozenset("script style noscript template title iframe object embed applet svg math canvas audio video select "
                   "textarea button datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog fieldset".split())
#: Their content is no markup: it ends at the literal end tag, or with the page.
RAW = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in ("script", "style")}
MAIN = frozenset("article main".split())
# Parts of class and id names that mark what is not the article.
HINT = re.compile(r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|banner|sponsor(?:ed)?|promo|menu|nav|navbar|navigation|sidebar|side|widget|"
                  r"footer|breadcrumbs?|cookies?|consent|notice|alert|popup|modal|newsletter|subscribe|share|sharing|social|comments?|"
                  r"comment-list|disqus|replies|related|recommended|login|signup|search|toolbar|masthead|copyright|legal|pagination|pager|tags)"
                  r"(?=$|[\s_-]|\d)", re.I)
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)>?|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

#: Names of the features, in the order of a block's vector.
FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
            "inside_boilerplate", "inside_main", "heading", "page_has_main")

# The labelled table, one row per kind of block: its words, link density and
# heading tag, its neighbours (words, link density), and where it stands
# (inside boilerplate, inside a main element, page has a main element).
WORDS, LINKS = (1, 5, 14, 50), (0.0, 0.2, 0.8)
NEIGHBOURS = ((0, 0.0), (4, 1.0), (5, 0.0), (15, 0.0))
PLACES = ((1, 0, 0), (1, 0, 1), (1, 1, 1), (0, 0, 1), (0, 1, 1), (0, 0, 0))


def _label(words: int, links: float, before: tuple, after: tuple, place: tuple, heading: int) -> int:
    """Whether such a block is article text.

    Words and links of the block and its neighbours decide everywhere but in
    boilerplate: inside a main element all but blocks of links that do not stand
    in running text, outside one running text in a run of it, and on a page
    without one also the headings and short blocks of running text.
    """
    inside_boilerplate, inside_main, page_has_main = place
    text = [n >= 10 and share < 0.5 for n, share in (before, after)]
    if inside_boilerplate:
        return 0
    if inside_main:
        return int(links < 0.5 or any(text))
    if page_has_main:
        return int(links < 0.5 and words >= 10 and all(text))
    return int(links < 0.5 and (words >= 10 or all(text) or heading and text[1] or text[0] and after == NEIGHBOURS[2]))


LABELLED = [((w, k, *before, *after, *place[:2], heading, place[2]), _label(w, k, before, after, place, heading))
            for w in WORDS for k in LINKS for before in NEIGHBOURS for after in NEIGHBOURS for place in PLACES for heading in (0, 1)]


def _gini(rows) -> float:
    p = sum(y for _, y in rows) / len(rows)
    return 2 * p * (1 - p) * len(rows)


def grow(rows: list[tuple[tuple, int]], depth: int = 12) -> tuple | int:
    """Decision tree ``(feature, threshold, low, high)`` with 0/1 leaves; ties take the earlier feature."""
    if depth == 0 or len({y for _, y in rows}) == 1:
        return int(2 * sum(y for _, y in rows) >= len(rows))
    best = None
    for f in range(len(rows[0][0])):
        values = sorted({x[f] for x, _ in rows})
        for a, b in zip(values, values[1:]):
            low, high = [r for r in rows if r[0][f] <= (a + b) / 2], [r for r in rows if r[0][f] > (a + b) / 2]
            loss = _gini(low) + _gini(high)
            if best is None or loss < best[0] - 1e-9:
                best = (loss, f, (a + b) / 2, low, high)
    if best is None:
        return int(2 * sum(y for _, y in rows) >= len(rows))
    _, f, cut, low, high = best
    return f, cut, grow(low, depth - 1), grow(high, depth - 1)


def decide(tree: tuple | int, x: tuple) -> int:
    while not isinstance(tree, int):
        f, cut, low, high = tree
        tree = low if x[f] <= cut else high
    return tree


def blocks(page: str) -> list[tuple[str, int, int, bool, bool, bool]]:
    """Flat text blocks ``(text, words, linked words, in boilerplate, in main, heading)`` in page order."""
    out: list[tuple[str, int, int, bool, bool, bool]] = []
    buf: list[str] = []
    linked, link = 0, 0
    stack: list[tuple[str, int, int]] = []  # element, whether it opens boilerplate, whether it opens the main part
    boiler = main = 0
    silent = ""
    head = False

    def flush() -> None:
        nonlocal linked
        if buf:
            text = " ".join(entities.unescape("".join(buf)).split())
            if text:
                out.append((text, text.count(" ") + 1, linked, boiler > 0, main > 0, head))
        buf.clear()
        linked = 0

    at = 0
    while m := TOKEN.match(page, at):
        at, name = m.end(), m[2]
        if silent:  # nothing inside counts until its own end tag
            if name and m[1] and name.lower() == silent:
                silent = ""
            continue
        if name is None:
            t = m[0]
            if t[0] != "<" or t == "<":
                buf.append(t)
                if link:
                    linked += len(t.split())
            elif t.startswith("<![CDATA["):
                buf.append(t[9:].removesuffix("]]>"))
            continue
        name, closing, attributes = name.lower(), m[1], m[3]
        if name in INLINE:
            if name == "a":
                link = 0 if closing else 1
            elif name == "br":
                buf.append(" ")
            continue
        if name in SILENT and not closing:
            if not attributes.endswith("/"):
                if name in RAW:
                    at = end.end() if (end := RAW[name].search(page, at)) else len(page)
                elif name not in VOID:
                    silent = name
                if name in ("title", "iframe", "object", "svg", "math", "noscript", "template", "audio", "video", "canvas"):
                    flush()
            continue
        flush()
        link = 0
        heading = name in ("h1", "h2", "h3", "h4", "h5", "h6")
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    for _, b, a in stack[i:]:
                        boiler -= b
                        main -= a
                    del stack[i:]
                    break
            head = head and not heading
        else:
            head = heading
            if name not in VOID and name != "p":
                hints = " ".join("".join(x) for x in ATTRIBUTE.findall(attributes)) if attributes else ""
                b = int(name in BOILERPLATE or name == "header" and not main or bool(hints and HINT.search(hints)) and name not in ("html", "body", "main"))
                a = int(name in MAIN or "articleBody" in attributes)
                boiler += b
                main += a
                stack.append((name, b, a))
    flush()
    return out


def vectors(found: list[tuple]) -> list[tuple]:
    """Feature vectors of a page's blocks: their own figures and those of their neighbours."""
    has_main = int(any(b[4] and not b[3] for b in found))
    near = [(0, 0.0), *((n, linked / n) for _, n, linked, *_ in found), (0, 0.0)]
    return [(*near[i], *near[i - 1], *near[i + 1], int(b[3]), int(b[4]), int(b[5]), has_main) for i, b in enumerate(found, 1)]


def main_text(page: str, tree: tuple | int) -> str:
    """Article blocks of a page, joined by an empty line."""
    found = blocks(page)
    return "\n\n".join([b[0] for b, x in zip(found, vectors(found)) if decide(tree, x)])


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url"), labelled=LABELLED) -> DataFrame:
    """The columns ``keep`` and ``text``: the article of each page, one row per input row.

    A null or empty page has an empty text. Null or repeated keys and repeated
    rows are kept as they are; other columns are dropped, whatever their names.
    The tree is grown on the driver from ``labelled``, a table of fixed size, and
    every block of every page is classified. An empty table gives no rows; a very
    long page is read whole, a block at a time.
    """
    tree = grow(labelled)
    kept = [pages[k] for k in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "__html"):
            text = [main_text(h, tree) if h else "" for h in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(text, pa.string())], [*keep, "text"])

    return arrow_map(pages.select(*kept, pages[html].alias("__html")), run, schema_of(pages, list(keep), "text string"))
