"""Hostile markup: the same events as from the standard parser alone, in time that grows with the page only."""

import random
import time
from html.parser import HTMLParser

import pytest

from tariffmill.functions.markup import one_pass
from tariffmill.operators.tables import read_tables

TOKENS = ["<p>", "</p>", "<b ", ">", "<", "text ", "&amp;", "<!--", "-->", "-- >", "<![CDATA[", "]]>", "] ]>", "<![if x]>", "<![endif]>", "<a b='", "'>", "</a>", "<?x", "<!doctype"]
MEGABYTE = 1_000_000
HOSTILE = [
    "<a ", "<!--", "<!--x>", "<![CDATA[>", "<![if ", "<a b='", "<a b='>", "<![x>", "</", "<!", "-- ", "<table><tr><td>x</table>", "&#", "<td", "<table><!--",
]


class Events(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.seen = []

    def handle_starttag(self, tag, attrs):
        self.seen.append(("start", tag))

    def handle_endtag(self, tag):
        self.seen.append(("end", tag))

    def handle_data(self, data):
        if self.seen and self.seen[-1][0] == "data":
            self.seen[-1] = ("data", self.seen[-1][1] + data)
        else:
            self.seen.append(("data", data))


def events(page):
    reader = Events()
    reader.feed(page)
    reader.close()
    return reader.seen


def test_same_events():
    rng = random.Random(7)
    for _ in range(4000):
        page = "".join(rng.choice(TOKENS) for _ in range(rng.randrange(1, 25)))
        assert events(one_pass(page)) == events(page), page


def test_unknown_sections_are_comments():
    with pytest.raises(AssertionError):
        events("a<![x y]>b")
    assert "".join(e[1] for e in events(one_pass("a<![x y]>b<![>c<![if z]>d")) if e[0] == "data") == "abcd"


@pytest.mark.parametrize("piece", HOSTILE)
@pytest.mark.parametrize("end", ["", ">"])
def test_a_megabyte_is_read_in_time(piece, end):
    start = time.time()
    read_tables(piece * (MEGABYTE // len(piece)) + end)
    assert time.time() - start < 5


def test_end_tags_without_start():
    start = time.time()
    read_tables("<table><tr><th>a<th>b</tr>" + "<b>" * 140_000 + "</i>" * 140_000 + "<tr><td>1<td>2</table>")
    assert time.time() - start < 5
