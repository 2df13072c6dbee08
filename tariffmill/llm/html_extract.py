"""Main text of HTML pages: parser events to lines, text-to-tag ratios, Gaussian smoothing, threshold clustering."""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffmill.functions.markup import one_pass
from tariffmill.llm.common import map_batches

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot"
    " th thead tr ul".split()
)
#: Elements whose text is never main text, wherever they stand.
SILENT = frozenset("script style noscript template head title iframe object svg canvas audio video math select textarea button".split())
#: Silent elements that are often left open.
SOFT = frozenset("iframe object canvas audio video select button".split())
_SOFT_START, _SOFT_END = (re.compile(rf"(?i)<{slash}({'|'.join(sorted(SOFT))})(?=[\s/>])") for slash in ("", "/"))
ASIDE = frozenset("nav footer aside form menu dialog header".split())
LANDMARK = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Words in class, id, role or aria-label that mark parts beside the main text.
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter"
    r"|subscri\w*|signup|login|comments?|commentlist|respond|replies|disqus|sidebar|side|aside|widget|related|recommend\w*|share|sharing"
    r"|social|menu|navbar|nav|navigation|breadcrumbs?|pagination|pager|footer|header|masthead|toolbar|skip|search\w*|form|complementary"
    r"|contentinfo|disclaimer|copyright)(?=$|[\s_-])",
    re.I,
)
BODY_MARK = re.compile(r"(?:^|[\s_-])(?:article|post|entry|story|main|content|body|text)(?=$|[\s_-]|body|content|text)", re.I)
CLOSED_BY_BLOCK = frozenset(("p",))
#: A start tag that ends an open element of its own kind, up to the nearest list or table.
ENDS_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr",), "th": ("tr",), "option": ("select",)}
SPACE = re.compile(r"\s+")


class LineParser(HTMLParser):
    """Lines of text, one per block, with the tags met in each, whether it is set aside or a heading, and the number of the
    outermost landmark it stands in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, bool]] = []  # tag, set aside, landmark
        self.counts: Counter[str] = Counter()  # of open tags
        self.blocks: list[int] = []  # where open blocks stand in ``open``
        self.inline: list[Counter[str]] = [Counter()]  # open tags that are no blocks, within each open block
        self.sought: dict[str, int] = {}  # blocks in which an element to be ended by a start tag was sought in vain
        self.unended: frozenset[str] = frozenset()
        self.muted = False
        self.beside = self.landmarks = self.headings = self.silent = self.met = 0
        self.lines: list[tuple[str, int, int, bool, int, bool]] = []  # text, tags, characters in links, beside, landmark or 0, heading
        self.parts: list[str] = []
        self.tags = self.linked = self.in_link = 0

    def read(self, page: str) -> list[tuple[str, int, int, bool, int, bool]]:
        """The lines of a whole page. A silent element that lacks end tags somewhere on the page is silent up to the next
        block only, as it would take all that follows for its own."""
        starts, ends = (Counter(m[1].lower() for m in re.finditer(p, page)) for p in (_SOFT_START, _SOFT_END))
        self.unended = frozenset(tag for tag in SOFT if starts[tag] > ends[tag])
        self.feed(one_pass(page))
        self.close()
        self.flush()
        return self.lines

    def flush(self) -> None:
        self.muted = False
        text = SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            self.lines.append((text, self.tags, self.linked, self.beside > 0, self.met if self.landmarks else 0, self.headings > 0))
            self.tags = 0
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
            self._close_implied(tag)
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        if tag in self.unended:
            self.muted = True
            return
        marks = " ".join(v for k, v in attrs if v and k in ("class", "id", "role", "aria-label"))
        hidden = any(k == "hidden" or (k == "aria-hidden" and v == "true") or (k == "style" and v and "display:none" in v.replace(" ", "")) for k, v in attrs)
        landmark = tag in LANDMARK or "role" in dict(attrs) and dict(attrs)["role"] in ("main", "article")
        in_heading = tag == "header" and self.landmarks
        beside = tag in SILENT or hidden or (tag in ASIDE and not in_heading)
        if not beside and marks and not landmark and tag not in ("body", "html") and MARKED.search(marks) and not in_heading:
            beside = not BODY_MARK.search(marks)
        if tag in BLOCKS:
            self.blocks.append(len(self.open))
            self.inline.append(Counter())
        else:
            self.inline[-1][tag] += 1
        self.counts[tag] += 1
        # an article within a part set aside, such as one comment, is not main text
        self.open.append((tag, beside, landmark))
        self.beside += beside
        self.met += landmark and not self.landmarks
        self.landmarks += landmark
        self.headings += tag in HEADINGS
        self.silent += tag in SILENT
        self.in_link += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        if tag in self.unended:
            self.muted = False
        # an end tag out of place does not reach beyond its block, unless it is a block's own
        if self.counts[tag] if tag in BLOCKS else self.inline[-1][tag]:
            self._pop(next(i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag))

    def handle_data(self, data):
        if self.silent or self.muted:
            return
        self.parts.append(data)
        if self.in_link:
            self.linked += len(data.strip())

    def _pop(self, at: int) -> None:
        self.flush() if any(t in BLOCKS for t, _, _ in self.open[at:]) else None
        first = len(self.open)  # the outermost block that is closed
        while self.blocks and self.blocks[-1] >= at:
            first = self.blocks[-1]
            self.blocks.pop()
            self.inline.pop()
        self.sought = {tag: min(n, len(self.blocks)) for tag, n in self.sought.items()}
        for i, (tag, beside, landmark) in enumerate(self.open[at:], at):
            self.counts[tag] -= 1
            # the counts within a closed block went with it
            self.inline[-1][tag] -= i < first
            self.beside -= beside
            self.landmarks -= landmark
            self.headings -= tag in HEADINGS
            self.silent -= tag in SILENT
            self.in_link -= tag == "a"
        del self.open[at:]

    def _close_implied(self, tag: str) -> None:
        """End tags that HTML lets authors leave out."""
        limits = ENDS_SAME.get(tag)
        # blocks looked through before need no second look while they are open
        for n in range(len(self.blocks) - 1, self.sought.get(tag, 0) - 1 if limits else -1, -1):
            name = self.open[self.blocks[n]][0]
            if name == "p" or (limits and name == tag):
                self._pop(self.blocks[n])
                return
            if not limits or name in limits:
                break
        if limits:
            self.sought[tag] = len(self.blocks)


def smoothed(values: np.ndarray, radius: int = 2) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines."""
    if len(values) < 2:
        return values
    offsets = np.arange(-radius, radius + 1)
    kernel = np.exp(-0.5 * (offsets / max(radius / 2, 0.5)) ** 2)
    padded = np.pad(values, radius, mode="edge")
    return np.convolve(padded, kernel / kernel.sum(), "valid")


def content_lines(lines: list[tuple[str, int, int, bool, int, bool]]) -> list[bool]:
    """Which lines are main text.

    A line's ratio is its text, without links, over the tags around it. Smoothed ratios over the threshold (one standard
    deviation, and at most half of the mean, of all lines) cluster into regions. Lines set aside by their elements are
    never taken. A region extends over all of a landmark that holds a line of it which is over the threshold by itself, so
    that short paragraphs and headings stay; a landmark without such a line is not taken for being one. Regions outside
    landmarks are taken too, beside chosen landmarks only where one of their lines is over the threshold by itself. Short
    lines between these, back to a heading before and on after the last belong to them, up to what is mostly links or set aside.
    """
    if not lines:
        return []
    ratio = np.asarray([max(len(t) - linked, 0) / max(tags, 1) if not beside else 0.0 for t, tags, linked, beside, *_ in lines], float)
    smooth = smoothed(ratio)
    threshold = min(float(ratio.std()), 0.5 * float(ratio.mean())) if len(lines) > 1 else 0.0
    threshold = max(threshold, 1e-9)
    own = np.asarray([not line[3] for line in lines])
    inside = np.asarray([line[4] for line in lines])
    region = (smooth >= threshold) & own
    solid = region & (ratio >= threshold)
    chosen = np.unique(inside[solid & (inside > 0)])
    taken = own & np.isin(inside, chosen) & (inside > 0)
    outside = region & (inside == 0) if len(chosen) else region
    starts = np.flatnonzero(outside & ~np.concatenate([[False], outside[:-1]]))
    ends = np.flatnonzero(outside & ~np.concatenate([outside[1:], [False]])) + 1
    runs = [(s, e) for s, e in zip(starts, ends, strict=True) if not len(chosen) or solid[s:e].any()]
    for s, e in runs:
        taken[s:e] = True
    if not runs:
        return taken.tolist()

    def short(i: int) -> bool:
        return bool(own[i]) and lines[i][2] * 2 <= len(lines[i][0])

    at = np.flatnonzero(taken)
    for i in range(at[0], at[-1]):
        taken[i] |= short(i)
    i = at[0] - 1
    while i >= 0 and short(i):
        if lines[i][5]:
            taken[i : at[0]] = True
        i -= 1
    i = at[-1] + 1
    while i < len(lines) and short(i) and not lines[i][5]:
        taken[i] = True
        i += 1
    return taken.tolist()


def main_text(html: str | None) -> str:
    """The main text of one page; null, empty and text-free pages give an empty string."""
    if not html:
        return ""
    lines = LineParser().read(html)
    return "\n".join(t[0] for t, keep in zip(lines, content_lines(lines), strict=True) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, main text and its length in code points for every row of ``pages (page_id, url, html, ...)``.

    White space inside a block is one space, blocks are joined by a line feed in page order, character references are
    decoded. Unclosed and misplaced tags are mended as browsers do for paragraphs, lists and tables. Repeated rows give
    repeated results; other columns are ignored.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h) for h in batch["html"].to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )

    narrow = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return map_batches(narrow, run, "page_id long, url string, text string, n_chars long", 200)
