"""Main text of pages with hostile and unfinished markup."""

import time

import pytest

from tariffmill.llm.html_extract import main_text

ARTICLE = "The quick brown fox jumps over the lazy dog and then some more words follow it here. "
PARAGRAPHS = "".join(f"<p>{ARTICLE}Part {i}.</p>" for i in range(5))
TEXT = "\n".join(f"{ARTICLE}Part {i}." for i in range(5))
QUARTER = 250_000  # of a megabyte
HOSTILE = [
    "<a ", "<!--", "<!--x>", "<![CDATA[>", "<![x>", "<a b='>", "<button>x<div><p>y", "<div>", "<li><ul>", "<b>", "</i>", "<dt><dd>", "<option>", "</section>",
]


@pytest.mark.parametrize("tag", ["button", "select", "object", "iframe", "video", "audio", "canvas"])
def test_unclosed_silent_elements_lose_no_article(tag):
    assert main_text(f"<html><body><{tag}>x<div>{PARAGRAPHS}</div></body></html>") == TEXT
    assert main_text(f"<body><nav><{tag} class='a'>Menu</nav><main>{PARAGRAPHS}</main>") == TEXT
    # a whole element stays silent, with blocks in it
    assert main_text(f"<body><main>{PARAGRAPHS}<{tag}><p>{ARTICLE}</p></{tag}></main>") == TEXT
    # one of two is left open
    assert main_text(f"<body><main><{tag}>a<p></p>{PARAGRAPHS}</main><{tag}>b</{tag}>") == TEXT


@pytest.mark.parametrize("piece", HOSTILE)
def test_hostile_pages_are_read_in_time(piece):
    start = time.time()
    main_text(piece * (QUARTER // len(piece)))
    main_text("<b>" * 20_000 + piece * 20_000)
    main_text("<li><ul>" + "<div>" * 20_000 + (piece + "<li></li>") * 10_000)
    assert time.time() - start < 8


def test_article_behind_hostile_markup():
    for piece in ("<!--", "<![CDATA[", "<b><i>", "</section>"):
        assert ARTICLE.strip() in main_text(piece * 1000 + f"<main>{PARAGRAPHS}</main>")
