"""Sections, chapters, designations and taxes out of record text and key-values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tariffmill import patterns as P
from tariffmill.functions.text import (
    blank_to_null,
    collapse_whitespace,
    contains_any,
    let,
    normalize_text,
    strip,
    strip_boilerplate,
)
from tariffmill.patterns import DEFAULT_RULES, MISSING, Rules
from tariffmill.schemas import TAX_TYPE

_DASH_LABEL = r"(?U)-\s*-+\s*([^\n]*)"
_FULL_CODE_TAIL = r"\s*(\d{2})\s*(\d{2})\s*-\s*-+\s*([^\n]*)"


def _or_missing(value: Column) -> Column:
    return F.coalesce(value, F.lit(MISSING))


def _extract(text: Column, pattern: Column, group: int) -> Column:
    """regexp_extract with a pattern that depends on the row."""
    return F.call_function("regexp_extract", text, pattern, F.lit(group))


def code_and_label(
    text: Column, key_values: Column, key: str, code_pattern: str, label_pattern: str, rules: Rules = DEFAULT_RULES
) -> Column:
    """Struct (code, label): from the key-value where there is one, else from the text."""
    split_pattern = f"(?s){rules.fallback_split}"

    def pair(code: Column, label: Column) -> Column:
        return F.struct(code.alias("code"), label.alias("label"))

    def labelled(code: Column) -> Column:
        # The label pattern holds the row's own code.
        pattern = F.concat(F.lit("(?isU)"), F.replace(F.lit(label_pattern), F.lit("{code}"), code))
        found = F.when(F.regexp_like(text, pattern), strip(_extract(text, pattern, 1)))
        return pair(_or_missing(code), _or_missing(found))

    def from_key(given: Column) -> Column:
        whole, parts = strip(given), F.split(given, "-", 2)
        split = F.when(
            F.rlike(whole, F.lit(split_pattern)),
            pair(F.regexp_extract(whole, split_pattern, 1), F.regexp_extract(whole, split_pattern, 2)),
        ).when(F.size(parts) == 2, pair(F.get(parts, 0), F.get(parts, 1)))
        return let(split, cleaned)

    def cleaned(split: Column) -> Column:
        found = pair(strip(split["code"]), strip_boilerplate(strip(split["label"]), rules))
        return F.when(split.isNull(), pair(F.lit(MISSING), F.lit(MISSING))).otherwise(found)

    given = blank_to_null(F.try_element_at(key_values, F.lit(key)))
    from_text = let(blank_to_null(F.regexp_extract(text, code_pattern, 1)), labelled)
    return let(given, lambda g: F.when(g.isNull(), from_text).otherwise(from_key(g)))


def extract_section(text: Column, key_values: Column, rules: Rules = DEFAULT_RULES) -> Column:
    return code_and_label(text, key_values, P.SECTION_KEY, rules.section_code, rules.section_label, rules)


def extract_chapter(text: Column, key_values: Column, rules: Rules = DEFAULT_RULES) -> Column:
    return code_and_label(text, key_values, P.CHAPTER_KEY, rules.chapter_code, rules.chapter_label, rules)


def extract_designation(text: Column, key_values: Column, hs_code: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """Label behind the full code, else the first dashed label after the six-digit code, else a key-value."""
    hs6 = F.concat_ws(".", F.substring(hs_code, 1, 4), F.substring(hs_code, 5, 2))
    full = F.concat(F.lit(r"(?U)\Q"), hs6, F.lit(r"\E"), F.lit(_FULL_CODE_TAIL))

    def in_text(after: Column) -> Column:
        # Too short a code has empty suffixes, which would equal the empty extract of no match.
        same_code = (
            (F.length(hs_code) >= 10)
            & (_extract(after, full, 1) == F.substring(hs_code, 7, 2))
            & (_extract(after, full, 2) == F.substring(hs_code, 9, 2))
        )
        return F.when(same_code, _extract(after, full, 3)).otherwise(F.regexp_extract(after, _DASH_LABEL, 1))

    def cleaned(raw: Column) -> Column:
        normal = F.coalesce(normalize_text(raw), F.lit(""))
        return F.when((raw == "") | (raw == MISSING), raw).otherwise(strip_boilerplate(normal, rules))

    start = F.instr(text, hs6)
    after = F.when(start > 0, text.substr(start, F.length(text)))
    found = F.nullif(blank_to_null(strip(let(after, in_text))), F.lit(MISSING))
    given = F.try_element_at(key_values, F.lit(P.DESIGNATION_KEY))
    return let(F.coalesce(found, given, F.lit(MISSING)), cleaned)


def parse_taxes(text: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """All taxes written as ``label ( code ) : value`` in a text."""

    def found(flat: Column) -> Column:
        label, code, value = (F.regexp_extract_all(flat, F.lit(rules.tax_main), F.lit(i)) for i in (1, 2, 3))
        coded = F.zip_with(label, code, lambda n, c: F.struct(n.alias("label"), c.alias("code")))
        return F.zip_with(
            coded,
            value,
            lambda t, v: F.struct(
                strip(t["code"]).alias("code"),
                strip_boilerplate(F.replace(strip(t["label"]), F.lit("*"), F.lit("")), rules).alias("label"),
                strip(v).alias("raw"),
            ),
        )

    return let(collapse_whitespace(text), found)


def parse_taxes_kv(key_values: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """Taxes out of the key-values of the page, header keys skipped."""
    entries = F.filter(F.map_entries(key_values), lambda e: ~contains_any(e["key"], P.TAX_KEY_SKIP))

    def tax(entry: Column) -> Column:
        key = entry["key"]
        code = blank_to_null(F.regexp_extract(key, rules.tax_code_from_key, 1))
        head = F.split(F.regexp_replace(key, rules.tax_key_clean, ""), r"\(", 2)[0]
        label = F.replace(strip(head), F.lit("*"), F.lit(""))
        return F.struct(
            _or_missing(strip(code)).alias("code"),
            strip_boilerplate(label, rules).alias("label"),
            entry["value"].alias("raw"),
        )

    return F.transform(entries, tax)


def taxes(from_text: Column, from_key_values: Column) -> Column:
    """Text taxes, or the key-value ones where the text has none."""
    empty = F.array().cast(f"array<{TAX_TYPE.simpleString()}>")
    return let(
        from_text, lambda found: F.when(F.size(found) > 0, found).otherwise(F.coalesce(from_key_values, empty))
    )
