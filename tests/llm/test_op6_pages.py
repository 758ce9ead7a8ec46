"""Main text of pages that have no article, several, or one that is not the article; broken heads and scripts."""

import pytest

from tessera.llm import html

TREE = html.grow(html.LABELLED)
BODY = [f"{w} paragraph of the story runs on with enough words to be read as running text by anyone at all" for w in ("First", "Second", "Third")]
DIVS = "<div class=story>" + "".join(f"<div>{b}</div>" for b in BODY) + "</div>"
LINKS = "<ul>" + "".join(f"<li><a href=/{i}>Some other page {i}</a></li>" for i in range(6)) + "</ul>"

PAGES = {
    "no article": f"<body><nav>{LINKS}</nav>{DIVS}<footer>about us</footer>",
    "related article in an aside": f"<body>{DIVS}<aside><article><p>Related story that stands aside</p></article></aside>",
    "cards in a comment list": f"<body>{DIVS}<div class=comments><article><p>I liked it a lot, thank you</p></article></div>",
    "comment articles": f"<body><article>{DIVS}</article><article class=comment><p>I liked it a lot, thank you</p></article>",
    "links inside the article": f"<body><article>{DIVS}<div class=x>{LINKS}</div></article>".replace("<ul>", "<ul><li><a href=/z>More to read here</a></li>"),
    "running text beside a card": f"<body>{LINKS}<div><p>{BODY[0]}</p><p>{BODY[1]}</p><p>{BODY[2]}</p></div>{LINKS}<article><p>Card</p></article>",
    "head without end": f"<html><head><title>T</title><meta charset=x><link rel=y><body>{DIVS}",
    "head without end or body": f"<html><head><title>T</title>{DIVS}",
    "script with tags and quotes": f"<body><script>if (a<b && c == \"it's) x('<!-- ')</script>{DIVS}<style>p>a{{content:'<b \"'}}</style>",
}


@pytest.mark.parametrize("name", PAGES)
def test_the_body_is_found(name):
    text = html.main_text(PAGES[name], TREE)
    kept = [b for b in BODY if b in text]
    assert kept == BODY if name != "running text beside a card" else BODY[1] in kept
    assert "liked" not in text and "Related" not in text and "other page 3" not in text and "content" not in text


def test_words_and_links_decide_on_pages_with_an_article():
    x = lambda words, links: html.decide(TREE, (words, links, 4, 1.0, 4, 1.0, 0, 1, 0, 1))
    assert x(20, 0.0) == 1 and x(5, 1.0) == 0
