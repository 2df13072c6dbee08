"""Line-by-line parsing of record text.

A record's text is one cell, so its lines are worked on in place: no explode, no shuffle, no window
over a record key, and a hot or repeated key costs nothing. Most of the work is one regex scan over
the whole text, which is far cheaper than a lambda call per line.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffmill import patterns as P
from tariffmill.functions.text import (
    WS_AHEAD,
    WS_CLASS,
    clean_label,
    contains_any,
    each,
    either,
    let,
    strip_boilerplate,
)
from tariffmill.patterns import DEFAULT_RULES, MISSING, Rules

_BREAK = r"[\n\x0b\f\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"
_INLINE_WS = rf"[\s\x1c-\x1f&&[^{_BREAK[1:-1]}]]"
_OTHER_BREAK = _BREAK.replace(r"\n", "")
# White space that splitting at \n would leave in: doubled, at the ends, or another kind of break.
_UNTIDY = rf"(?U){WS_AHEAD}(?:{WS_CLASS}(?:{WS_CLASS}|\z|(?<={_OTHER_BREAK}))|\A{WS_CLASS})"
# A white-space run with a line break in it, or at an end. The look-behind admits only starts of runs,
# so that a long run of blanks is looked at once.
_LINE_END = (
    rf"(?U){WS_AHEAD}(?:(?![ \n][!-~])(?:{_BREAK}{WS_CLASS}*+"
    rf"|{_INLINE_WS}(?<!{WS_CLASS}{{2}}){_INLINE_WS}*+(?:{_BREAK}{WS_CLASS}*+|\z))"
    rf"|\A{_INLINE_WS}++)"
)

# Patterns on joined lines: ^ and $ are line ends, and only \n breaks lines.
_LINES = "(?dmU)"
_DATE_START = r"^\d{2}/\d{2}/\d{4}"
_DATE_ANYWHERE = r"\d{2}/\d{2}/\d{4}"
_NUMERIC_LINE = r"^\d+[\d\.]*$"
_CODE_LINE = P.DOCUMENT_CODE.removeprefix("^")
_DOCUMENT = rf"{_LINES}^{_CODE_LINE}(?:\n(?!{_CODE_LINE}).+$){{0,2}}"
# the fixed rate pattern on one of many lines, where white space must not run on to the next
_RATE_LINE = r"(?:" + P.AGREEMENT_RATE.removeprefix("^").removesuffix("$").replace(r"\s", r"[^\S\n]") + r"|\(\*\))$"
_REGIME_WORD = f"(?i:{'|'.join(P.AGREEMENT_REGIME_WORDS)})"
_AGREEMENT = (
    rf"{_LINES}^(?!{_RATE_LINE})(?!.*{_REGIME_WORD}).+$(?:\n(?:{_RATE_LINE}|(?=.*{_REGIME_WORD}).+$))*+"
)
_HISTORY = rf"{_LINES}{_DATE_START}(?=.*(?:\n.*(?:\n(.*))?)?)"


def _words(words: Sequence[str]) -> str:
    return "|".join(re.escape(w) for w in words)


def joined_lines(text: Column) -> Column:
    """Stripped non-blank lines of a text, joined by line breaks, with perhaps one more at the ends."""

    def tidy(t: Column) -> Column:
        return F.when(F.rlike(t, F.lit(_UNTIDY)), F.regexp_replace(t, _LINE_END, "\n")).otherwise(t)

    return let(F.coalesce(text, F.lit("")), tidy)


def text_lines(text: Column) -> Column:
    """Stripped non-blank lines of a text; NULL text has none."""
    return F.array_remove(F.split(joined_lines(text), "\n"), "")


def explode_lines(df: DataFrame, text_col: str, *keep: str) -> DataFrame:
    """One row per line with its position, counted from 0."""
    return df.select(*keep, F.posexplode(text_lines(F.col(text_col))).alias("pos", "line"))


def _without(lines: Column, noise: str) -> Column:
    """Joined lines without those that match a pattern as a whole."""
    return F.regexp_replace(lines, rf"{_LINES}^(?:{noise})(?:\n|\z)", "")


def document_lines(text: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """Joined lines of the documents section without those that carry no document."""
    # A line 'NA' equals the missing marker and never fills a field.
    exact = _words([*P.DOCUMENT_NOISE_LINES, *rules.boilerplate, MISSING])
    parts = _words([*rules.document_keys, *(b for b in rules.boilerplate if len(b) > 4)])
    return _without(joined_lines(text), exact + (f"|.*(?:{parts}).*" if parts else ""))


def parse_documents(text: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """Required documents: a 3-5 digit line, then its name, then its issuer; repeats dropped.

    Each block of up to three lines is its own key for the distinct, which hashes texts but would
    compare structs pair by pair.
    """

    def document(parts: Column) -> Column:
        code, name, issuer = (F.coalesce(F.get(parts, i), F.lit(MISSING)) for i in range(3))
        return F.struct(code.alias("code"), issuer.alias("issuer"), name.alias("name"), code.alias("raw"))

    blocks = F.array_distinct(F.regexp_extract_all(document_lines(text, rules), F.lit(_DOCUMENT), F.lit(0)))
    return F.transform(blocks, lambda block: let(F.split(block, "\n"), document))


def is_rate(line: Column) -> Column:
    return F.rlike(line, F.lit(f"(?U){P.AGREEMENT_RATE}")) | (line == "(*)") | (line == "0")


def is_regime(line: Column) -> Column:
    return contains_any(F.upper(line), P.AGREEMENT_REGIME_WORDS)


def classify_agreement_line(line: Column) -> Column:
    """``rate``, ``regime`` or ``country``."""
    return F.when(is_rate(line), "rate").when(is_regime(line), "regime").otherwise("country")


def agreement_lines(text: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """Joined lines of the agreements section without its noise."""
    exact = _words([*P.AGREEMENT_NOISE_LINES, *rules.boilerplate])
    parts = rf"{_words(P.AGREEMENT_NOISE_PARTS)}|{_DATE_ANYWHERE}"
    short = rf"(?!(?:{_words(P.AGREEMENT_SHORT_NAMES)})$|{_RATE_LINE}).{{1,2}}"
    return _without(joined_lines(text), rf"{exact}|.*(?:{parts}).*|\(\*\).*|{short}")


def parse_agreements(text: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """Agreements: a country line, regime lines joined, first two rates as DI and TPI; repeats dropped."""

    def key(block: Column) -> Column:
        country = F.substring_index(block, "\n", 1)
        body = block.substr(F.length(country) + 2, F.length(block))
        rates = F.regexp_extract_all(body, F.lit(rf"{_LINES}^{_RATE_LINE}"), F.lit(0))
        regimes = F.regexp_extract_all(body, F.lit(rf"{_LINES}^(?!{_RATE_LINE}).+$"), F.lit(0))
        regime = F.coalesce(F.nullif(F.array_join(regimes, " "), F.lit("")), F.lit(MISSING))
        return let(
            rates,
            lambda r: F.concat_ws(
                "\n", country, regime, F.coalesce(F.get(r, 0), F.lit(MISSING)), F.coalesce(F.get(r, 1), F.lit(MISSING))
            ),
        )

    def agreement(k: Column) -> Column:
        return F.struct(
            k[2].alias("DI"), k[3].alias("TPI"), k[0].alias("country"), k[1].alias("list"), k[0].alias("raw")
        )

    blocks = F.regexp_extract_all(agreement_lines(text, rules), F.lit(_AGREEMENT), F.lit(0))
    keys = F.array_distinct(F.transform(blocks, key))
    return F.transform(keys, lambda k: let(F.split(k, "\n"), agreement))


def parse_history(text: Column) -> Column:
    """Duty history: each line starting with a date takes the line two further on as its rate."""

    def found(lines: Column) -> Column:
        return F.zip_with(
            F.regexp_extract_all(lines, F.lit(_HISTORY), F.lit(0)),
            F.regexp_extract_all(lines, F.lit(_HISTORY), F.lit(1)),
            lambda day, rate: F.struct(
                F.try_to_date(day, "dd/MM/yyyy").cast("string").alias("date"), F.concat(F.lit("Taux: "), rate).alias("raw")
            ),
        )

    return let(joined_lines(text), found)


def _positions(lines: Column, wanted) -> Column:
    """Indices, counted from 0, of the lines that satisfy a condition."""
    marked = F.transform(lines, lambda line, i: F.when(wanted(line), i))
    return F.filter(marked, lambda i: i.isNotNull())


def _spans(lines: Column, wanted) -> Column:
    """(start, stop) of the blocks that begin at the lines satisfying a condition."""

    def paired(starts: Column) -> Column:
        return F.transform(
            starts,
            lambda s, k: F.struct(s.alias("start"), F.coalesce(F.get(starts, k + 1), F.size(lines)).alias("stop")),
        )

    return let(_positions(lines, wanted), paired)


def hierarchy_lines(text: Column) -> Column:
    """Lines from the codification marker on, without the last one, which is the unit."""
    main, alt = F.locate(P.HIERARCHY_START, text), F.locate(P.HIERARCHY_START_ALT, text)
    start = F.when(main > 0, main).when(alt > 0, alt).otherwise(1)
    return let(
        text_lines(text.substr(start, F.length(text))),
        lambda lines: F.slice(lines, F.lit(1), F.greatest(F.size(lines) - 1, F.lit(0))),
    )


LEVELS = ("HS4", "HS6", "HS8", "HS10")


def hierarchy_segments(lines: Column, hs_code: Column) -> Column:
    """Blocks of lines, each split over the four levels.

    HS4 and HS6 markers start a block. Within an HS6 block the HS8 lines begin at the first HS8
    suffix, and the HS10 lines at the first HS10 suffix behind that.
    """
    hs4 = F.concat_ws(".", F.substring(hs_code, 1, 2), F.substring(hs_code, 3, 2))
    hs6 = F.concat_ws(".", F.substring(hs_code, 1, 4), F.substring(hs_code, 5, 2))
    hs8, hs10 = F.substring(hs_code, 7, 2), F.substring(hs_code, 9, 2)
    none = F.array().cast("array<string>")

    def cut(body: Column, suffix: Column) -> Column:
        """Lines before and behind the first suffix line."""

        def at(position: Column) -> Column:
            found = position > 0
            return F.struct(
                F.when(found, F.slice(body, F.lit(1), position - 1)).otherwise(body).alias("before"),
                F.when(found, F.slice(body, position + 1, F.size(body))).otherwise(none).alias("behind"),
            )

        return let(F.array_position(body, suffix).cast("int"), at)

    def hs6_levels(body: Column) -> Column:
        return let(
            cut(body, hs8),
            lambda six: let(
                cut(six["behind"], hs10),
                lambda eight: F.struct(
                    none.alias("HS4"),
                    six["before"].alias("HS6"),
                    eight["before"].alias("HS8"),
                    eight["behind"].alias("HS10"),
                ),
            ),
        )

    def blocks(bound: Column) -> Column:
        def levels(span: Column) -> Column:
            body = F.slice(bound, span["start"] + 2, span["stop"] - span["start"] - 1)
            only_hs4 = F.struct(body.alias("HS4"), none.alias("HS6"), none.alias("HS8"), none.alias("HS10"))
            return F.when(F.get(bound, span["start"]) == hs4, only_hs4).otherwise(let(body, hs6_levels))

        return F.transform(_spans(bound, lambda line: (line == hs4) | (line == hs6)), levels)

    return let(lines, blocks)


def level_lines(segments: Column, level: str) -> Column:
    """All lines of a level but the purely numeric ones."""
    return F.filter(
        F.flatten(F.transform(segments, lambda s: s[level])), lambda line: ~F.rlike(line, F.lit(_NUMERIC_LINE))
    )


def hierarchy_labels(
    text: Column, hs_code: Column, designation: Column, rules: Rules = DEFAULT_RULES
) -> Column:
    """Struct of hs4_label, hs6_label, hs8_label and hs10_label: joined and cleaned label lines.

    Where no label is left, the last one is the designation and the others are the missing marker.
    """

    def joined(segments: Column) -> Column:
        texts = [F.array_join(level_lines(segments, level), " ") for level in LEVELS]
        return each(texts, lambda t: clean_label(strip_boilerplate(t, rules), rules))

    def named(labels: Column) -> Column:
        fallback = [F.lit(MISSING)] * 3 + [designation]
        return F.struct(*[
            F.coalesce(labels[i], fallback[i]).alias(f"{level.lower()}_label") for i, level in enumerate(LEVELS)
        ])

    return let(let(hierarchy_segments(hierarchy_lines(text), hs_code), joined), named)


def final_designation(hs10_label: Column, designation: Column) -> Column:
    """The HS10 label unless it is the missing marker."""
    return F.when(hs10_label.isNull() | (hs10_label != MISSING), hs10_label).otherwise(designation)


def unit_of_measure(text: Column, metadata: Column) -> Column:
    """Last line when short, else the unit from the metadata, else 'U'; no text gives the missing marker."""
    last = F.try_element_at(text_lines(text), F.lit(-1))
    from_metadata = F.coalesce(F.try_element_at(metadata, F.lit("unit")), F.lit("U"))
    return (
        F.when(last.isNull(), MISSING)
        .when(F.length(last) <= 5, last)
        .otherwise(from_metadata)
    )
