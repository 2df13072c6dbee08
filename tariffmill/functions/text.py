"""Text cleaning, numbers, dates and code padding as column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tariffmill import patterns as P
from tariffmill.functions.bind import fixed_map, let
from tariffmill.functions.compose import compose_unicode
from tariffmill.patterns import DEFAULT_RULES, Rules

# All characters Python calls white space; Java's \s and Spark's trim know only the ASCII ones.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
# As a regex class it is one table look-up per character under (?U), plus four separators.
WS_CLASS = r"[\s\x1c-\x1f]"
# All of them lie here; letters and digits fail this look ahead at once, before the dearer classes are asked.
WS_AHEAD = r"(?=[\x00-\x20\x{85}\x{a0}\x{1680}-\x{3000}])"
# Runs that are not a single blank already, so that plain text passes without a copy per word.
_WS_RUN = rf"(?U){WS_AHEAD}(?:[\s\x1c-\x1f&&[^ ]]{WS_CLASS}*+| {WS_CLASS}++)"

_HALF_WIDTH = "".join(chr(i) for i in range(0x21, 0x7F))
_FULL_WIDTH = "".join(chr(i - 0x21 + 0xFF01) for i in range(0x21, 0x7F))
_CURLY = "‘’‚‛“”„‟"
_STRAIGHT = "''''\"\"\"\""
_CONTROL = r"[\x00-\x08\x0e-\x1b\x7f]|\x1b\[[0-9;]*m"

# UTF-8 read as Windows-1252: the characters that bytes 0x80 to 0xBF then show as.
_BYTES_1252 = {b: bytes([b]).decode("cp1252", errors="ignore") or chr(b) for b in range(0x80, 0xC0)}
_SHOWN = "".join(c for b, c in _BYTES_1252.items() if c != chr(b))
_MEANT = "".join(chr(b) for b, c in _BYTES_1252.items() if c != chr(b))
_TAIL = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in _BYTES_1252.values()) + "]"
# Lead bytes of the Latin letters and of general punctuation; others occur in sound French text.
_GARBLED = f"[ÂÃÅ]{_TAIL}|â[€‚]{_TAIL}"
_PIECE = f"{_GARBLED}|[^ÂÃÅâ]+|[ÂÃÅâ]"
# Control characters, lead characters and all beyond Latin letters: only texts with these need work.
_CONTROLS = "".join(f"\\x{i:02x}" for i in [*range(0x09), *range(0x0E, 0x1C), *range(0x7F, 0xA0)])
_UNUSUAL = f"[{_CONTROLS}ÂÃÅ\\x{{180}}-\\x{{10ffff}}]|â[€‚]"


def either(conditions: Sequence[Column]) -> Column:
    """OR of a short fixed list of conditions; false for none."""
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """True where the text holds one of the literal words."""
    return either([F.contains(text, F.lit(w)) for w in words])


def strip(text: Column) -> Column:
    """Cut white space, Unicode included, off both ends; linear in the text."""
    return F.btrim(text, F.lit(WHITESPACE))


def collapse_whitespace(text: Column) -> Column:
    """Runs of white space become one blank; none at the ends."""
    return F.btrim(F.regexp_replace(text, _WS_RUN, " "))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def fix_mojibake(text: Column) -> Column:
    """Repair Latin letters and punctuation that were UTF-8 and read as Windows-1252."""

    def repair(piece: Column) -> Column:
        encoded = F.encode(F.translate(piece, _SHOWN, _MEANT), "ISO-8859-1")
        return F.when(F.rlike(piece, F.lit(f"^(?:{_GARBLED})")), F.decode(encoded, "UTF-8")).otherwise(piece)

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0)), repair), "")


def fix_characters(text: Column) -> Column:
    """Straight quotes, plain ligatures and widths, no control characters."""
    plain = F.translate(text, _CURLY + _FULL_WIDTH, _STRAIGHT + _HALF_WIDTH)
    for ligature, letters in (("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff")):
        plain = F.replace(plain, F.lit(ligature), F.lit(letters))
    return F.regexp_replace(plain, _CONTROL, "")


def normalize_text(text: Column) -> Column:
    """Repair the encoding, normalise and compose characters, collapse white space; empty becomes NULL."""
    repaired = let(
        text, lambda t: F.when(F.rlike(t, F.lit(_UNUSUAL)), compose_unicode(fix_characters(fix_mojibake(t)))).otherwise(t)
    )
    return let(collapse_whitespace(repaired), blank_to_null)


def regex_rules(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Apply an ordered list of (pattern, replacement)."""
    return reduce(lambda t, rule: F.regexp_replace(t, rule[0], rule[1]), rules, text)


def boilerplate_rules(rules: Rules = DEFAULT_RULES) -> list[tuple[str, str]]:
    """Replacement list that removes site boilerplate, timestamps and rulers."""
    out = []
    if rules.boilerplate:
        words = "|".join(re.escape(w) for w in rules.boilerplate)
        out.append((f"(?iu){words}", ""))
    return [*out, (P.TIMESTAMP_NOISE, ""), (P.RULER_NOISE, "")]


def strip_boilerplate(text: Column, rules: Rules = DEFAULT_RULES) -> Column:
    return normalize_text(regex_rules(text, boilerplate_rules(rules)))


def clean_label(text: Column, rules: Rules = DEFAULT_RULES) -> Column:
    return normalize_text(regex_rules(text, rules.label_rules))


def each(values: Sequence[Column], body: Callable[[Column], Column]) -> Column:
    """Array of a body applied to several values; the body stands in the plan once."""
    return F.transform(F.array(*values), lambda value: body(value))


_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _to_double(text: Column) -> Column:
    return F.when(F.rlike(text, F.lit(_NUMBER)), text.try_cast("double"))


def parse_percentage(text: Column) -> Column:
    """French decimal, optional percent sign, to double; anything else is NULL."""
    bare = F.regexp_replace(F.replace(text, F.lit("%"), F.lit("")), f"(?U){WS_CLASS}", "")
    return _to_double(F.replace(bare, F.lit(","), F.lit(".")))


def cell_number(text: Column) -> Column:
    """Fraction for a cell like ``12,5 %``; NULL for any other text."""
    cell = strip(text)
    number = F.replace(F.replace(cell, F.lit("%"), F.lit("")), F.lit(","), F.lit("."))
    return F.when(F.endswith(cell, F.lit("%")), _to_double(strip(number)) / 100)


def normalize_cell(text: Column) -> Column:
    """Struct of the stripped text and, for percentages, the fraction."""
    return F.struct(strip(text).alias("text"), cell_number(text).alias("number"))


def clean_cell(text: Column) -> Column:
    return collapse_whitespace(text)


_MONTHS = {
    1: ("janvier", "janv", "jan"),
    2: ("février", "fevrier", "févr", "fevr", "fév", "fev"),
    3: ("mars", "mar"),
    4: ("avril", "avr"),
    5: ("mai",),
    6: ("juin",),
    7: ("juillet", "juil"),
    8: ("août", "aout"),
    9: ("septembre", "sept", "sep"),
    10: ("octobre", "oct"),
    11: ("novembre", "nov"),
    12: ("décembre", "decembre", "déc", "dec"),
}
_NUMERIC_DATE = r"^\d{1,2}[/.-]\d{1,2}[/.-]\d{4}(?!\d)"
_ISO_DATE = r"^\d{4}-\d{2}-\d{2}"
_WORDED_DATE = r"^(?:\p{L}+\s+)?(\d{1,2})(?:er)?\s+(\p{L}+)\.?\s+(\d{4})$"


def parse_french_date(text: Column) -> Column:
    """Day-first date, numeric or with a French month name, as ISO text; anything else is NULL."""
    months = fixed_map({name: str(month) for month, names in _MONTHS.items() for name in names})

    def parsed(t: Column) -> Column:
        day, month, year = (F.regexp_extract(t, _WORDED_DATE, i) for i in (1, 2, 3))
        numeric = F.translate(F.regexp_extract(t, _NUMERIC_DATE, 0), ".-", "//")
        worded = F.concat_ws("/", day, F.coalesce(F.try_element_at(months, month), F.lit("0")), year)
        shaped = F.when(F.rlike(t, F.lit(_NUMERIC_DATE)), numeric).when(F.rlike(t, F.lit(_WORDED_DATE)), worded)
        return F.coalesce(
            F.try_to_date(shaped, "d/M/yyyy"),
            F.when(F.rlike(t, F.lit(_ISO_DATE)), F.try_to_date(F.substring(t, 1, 10), "yyyy-MM-dd")),
        ).cast("string")

    return let(F.lower(strip(text)), parsed)


def zfill_code(code: Column, width: int = 2) -> Column:
    """Pad with zeros on the left, never cutting longer codes."""
    return F.lpad(code, F.greatest(F.length(code), F.lit(width)), F.lit("0"))
