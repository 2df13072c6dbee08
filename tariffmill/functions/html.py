"""HTML pages to text, key-values, links and section types, as column expressions."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from tariffmill import patterns as P
from tariffmill.functions.text import blank_to_null, collapse_whitespace, contains_any, fixed_map, let, strip
from tariffmill.schemas import TABLE_TYPE

# One scan tells markup from text: comments, script and style with their bodies, then any other tag.
_TAG = r"<[/!?a-z][^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+>|<[/!?a-z][^>]*>"
_MARKUP = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<script\b[^>]*>.*?(?:</script\s*>|\z)"
    r"|<style\b[^>]*>.*?(?:</style\s*>|\z)"
    rf"|{_TAG}"
)
_ANCHOR = r"(?is)<a(?:\s[^>]*)?>(.*?)</a\s*>"
_CUT, _END, _LOOSE = "\x01", "\x02", "\x03"

# Named references from the standard table; numbers 128-159 mean Windows-1252 there.
_ENTITIES = {name.rstrip(";"): text for name, text in sorted(html5.items())}
_WINDOWS_1252 = {i: bytes([i]).decode("cp1252", errors="ignore") for i in range(128, 160)}
# Map look-ups scan, so the usual ones are asked first.
_USUAL = ["amp", "nbsp", "quot", "eacute", "egrave", "agrave", "lt", "gt", "apos", "copy", "middot"]
_USUAL_MAP = {name: _ENTITIES[name] for name in _USUAL}
_ENTITY = r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);?"
_REPLACEMENT = "\ufffd"


def _entity_char(name: Column) -> Column:
    """The text of a reference; a number that is no character gives the replacement character, an unknown name NULL."""
    numbered = F.regexp_replace(name, "^#[xX]?0*", "")
    base = F.when(F.rlike(name, F.lit("^#[xX]")), 16).otherwise(10)
    # longer numbers, leading zeros aside, are beyond all characters
    point = F.when(F.length(numbered) <= 7, F.conv(F.concat(F.lit("0"), numbered), 16, 10).cast("int"))
    point = F.when(base == 16, point).otherwise(F.when(F.length(numbered) <= 7, F.concat(F.lit("0"), numbered).try_cast("int")))
    char = let(
        point,
        lambda n: F.when((n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF), F.coalesce(
            blank_to_null(F.try_element_at(fixed_map({str(i): c for i, c in _WINDOWS_1252.items()}), n.cast("string"))),
            F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"),
        )).otherwise(_REPLACEMENT),
    )
    named = F.coalesce(F.try_element_at(fixed_map(_USUAL_MAP), name), F.try_element_at(fixed_map(_ENTITIES), name))
    return F.when(F.startswith(name, F.lit("#")), char).otherwise(named)


def decode_entities(text: Column) -> Column:
    """Replace named and numbered character references in one pass; unknown ones stay as text."""

    def decode(piece: Column, i: Column) -> Column:
        found = F.regexp_extract(piece, _ENTITY, 0)
        rest = piece.substr(F.length(found) + 1, F.length(piece))
        char = let(F.regexp_extract(piece, _ENTITY, 1), _entity_char)
        return F.when(i == 0, piece).otherwise(F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), piece)))

    def whole(t: Column) -> Column:
        return F.when(F.contains(t, F.lit("&")), F.array_join(F.transform(F.split(t, "&"), decode), "")).otherwise(t)

    return let(text, whole)


def _without_markup(html: Column) -> Column:
    """Markup replaced by cuts. No tag ends behind the last ``>``, so tags are sought up to there only, which keeps
    the scan linear; the rest is text unless a comment, script or style that was never closed reaches into it."""

    def cut(page: Column) -> Column:
        end = F.length(page) - F.locate(">", F.reverse(page)) + 1
        head = F.when(F.contains(page, F.lit(">")), F.substring(page, 1, end)).otherwise("")
        tail = F.when(F.contains(page, F.lit(">")), F.substring(page, end + 1, F.length(page))).otherwise(page)
        text = F.regexp_replace(tail, "(?s)<!--.*", _CUT)
        marked = F.regexp_replace(F.concat(head, F.lit(_END)), _MARKUP, _CUT)
        return F.replace(marked, F.lit(_END), text)

    return let(html, cut)


def html_to_text(html: Column) -> Column:
    """Visible text nodes, stripped, blank ones dropped, one per line; empty or NULL gives ''."""
    nodes = F.split(_without_markup(html), _CUT)
    kept = F.filter(F.transform(nodes, lambda n: strip(decode_entities(n))), lambda n: n != "")
    return F.coalesce(F.array_join(kept, "\n"), F.lit(""))


def content_length(text: Column) -> Column:
    return F.length(text)


def extract_metadata(text: Column, patterns: dict[str, str] | None = None) -> Column:
    """First match of each pattern, case ignored; absent keys are left out."""
    entries: list[Column] = []
    for key, pattern in (patterns or P.METADATA_PATTERNS).items():
        found = F.regexp_extract(text, f"(?iuU){pattern}", 1)
        entries += [F.lit(key), strip(blank_to_null(found))]
    return F.map_filter(F.create_map(*entries), lambda _, v: v.isNotNull())


def last_wins_map(entries: Column) -> Column:
    """Map from an array of (key, value): the last value of a key, at the place of its first one.

    Sorting keys and places keeps this at n log n for pages with many keys, and needs no session setting.
    """

    def key_at(ordered: Column, i: Column) -> Column:
        return F.get(ordered, i)["key"]

    def spans(ordered: Column) -> Column:
        """First and last place of each key."""
        firsts = F.filter(ordered, lambda e, i: ~key_at(ordered, i - 1).eqNullSafe(e["key"]))
        lasts = F.filter(ordered, lambda e, i: ~key_at(ordered, i + 1).eqNullSafe(e["key"]))
        return F.zip_with(
            firsts, lasts, lambda a, b: F.struct(a["pos"].alias("first"), b["pos"].alias("last"))
        )

    def build(bound: Column) -> Column:
        placed = F.transform(bound, lambda e, i: F.struct(e["key"].alias("key"), i.alias("pos")))
        unique = F.array_sort(let(F.array_sort(placed), spans))
        return F.map_from_entries(F.transform(unique, lambda s: F.get(bound, s["last"])))

    return let(entries, build)


def _notes_that_close(text: Column) -> Column:
    """Brackets behind the last closing one open no note; they are set apart, so that no scan for their end starts."""
    end = F.length(text) - F.locate(")", F.reverse(text)) + 1
    closed = F.contains(text, F.lit(")"))
    head = F.when(closed, F.substring(text, 1, end)).otherwise("")
    tail = F.when(closed, F.substring(text, end + 1, F.length(text))).otherwise(text)
    return F.concat(head, F.translate(tail, "(", _LOOSE))


def extract_key_values(text: Column) -> Column:
    """Every ``key (note) : value``; keys may span lines, long values are dropped, later keys win."""
    pattern = F.lit(f"(?U){P.KEY_VALUE_PATTERN}")

    def as_was(part: Column) -> Column:
        return F.translate(part, _LOOSE, "(")

    def pairs(usable: Column) -> Column:
        return F.zip_with(
            F.regexp_extract_all(usable, pattern, F.lit(1)),
            F.regexp_extract_all(usable, pattern, F.lit(2)),
            lambda k, v: F.struct(strip(as_was(k)).alias("key"), strip(as_was(v)).alias("value")),
        )

    # Cutting behind the last usable colon keeps the search linear: no start position fails.
    usable = F.regexp_extract(text, r"(?sU)^(.*:\s*[^\n]+)", 1)
    usable = let(usable, _notes_that_close)
    kept = F.filter(
        let(usable, pairs),
        lambda e: (e["key"] != "") & (e["value"] != "") & (F.length(e["value"]) < P.KEY_VALUE_MAX_LENGTH),
    )
    return last_wins_map(kept)


def section_type(name: Column, content: Column, keywords: dict[str, list[str]] | None = None) -> Column:
    """Type by keyword in the name, else by the best-scoring content patterns, else the general type."""
    keywords = keywords or P.SECTION_TYPE_KEYWORDS

    def score(clean: Column, words: list[str]) -> Column:
        return sum((F.rlike(clean, F.lit(f"(?U){w}")).cast("int") for w in words), F.lit(0))

    def by_score(clean: Column) -> Column:
        scores = F.array(*[score(clean, words) for words in keywords.values()])
        kinds = F.array(*[F.lit(kind) for kind in keywords])
        # the first position of the maximum is the earliest type
        return let(
            scores,
            lambda s: F.when(F.array_max(s) == 0, P.SECTION_TYPE_DEFAULT).otherwise(
                F.element_at(kinds, F.array_position(s, F.array_max(s)).cast("int"))
            ),
        )

    by_name = F.lit(None).cast("string")
    for kind, words in reversed(keywords.items()):
        literal = [w for w in words if not w.startswith("\\")]
        by_name = F.when(contains_any(F.lower(name), literal), kind).otherwise(by_name)
    return F.coalesce(by_name, let(F.lower(F.regexp_replace(content, "<[^>]+>", " ")), by_score))


def nav_links(html: Column, skip_words: list[str] | None = None) -> Column:
    """Anchor texts of a page in first-seen order, without repeats, blanks and skip words."""
    # an anchor needs an end tag, so nothing behind the last one is looked at
    usable = F.regexp_extract(html, r"(?is)^(.*</a\s*>)", 1)
    texts = F.transform(
        F.regexp_extract_all(usable, F.lit(_ANCHOR), F.lit(1)),
        lambda a: collapse_whitespace(decode_entities(F.regexp_replace(a, _MARKUP, ""))),
    )
    skip = skip_words or P.NAV_SKIP_WORDS
    return F.array_distinct(F.filter(texts, lambda t: (t != "") & ~contains_any(F.lower(t), skip)))


def scrape_status(error: Column, main_html: Column) -> Column:
    """``error`` when the fetch failed, ``partial`` when only the main page is missing, else ``success``."""
    return F.when(error.isNotNull(), "error").when(main_html.isNull(), "partial").otherwise("success")


def page_content(html: Column, tables: Column | None = None) -> Column:
    """The content struct of a page."""
    return let(html_to_text(html), lambda text: content_of_text(text, tables))


def content_of_text(text: Column, tables: Column | None = None) -> Column:
    """The content struct of a text; ``tables`` come from the table reader where they are wanted."""
    none = F.array().cast(f"array<{TABLE_TYPE.simpleString()}>")
    return F.struct(
        text.alias("raw_text"),
        extract_metadata(text).alias("metadata"),
        extract_key_values(text).alias("key_values"),
        (none if tables is None else tables).alias("tables"),
        content_length(text).alias("length"),
    )
