"""Unicode composition (NFC) as a column expression.

The tables come from the character database of Python's standard library, by rule. A text without combining
characters passes after one scan. In others only the clusters that may change are taken apart, their marks put in
the order of their combining classes, and composed again, each different cluster of a text once; all steps are linear in the
text, also for endless marks.
"""

from __future__ import annotations

import sys
import unicodedata
from collections import defaultdict
from collections.abc import Iterable
from functools import cache

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

# Hangul syllables compose by arithmetic: lead, vowel and tail consonants.
_SYLLABLE, _LEAD, _VOWEL, _TAIL = 0xAC00, 0x1100, 0x1161, 0x11A7
_LEADS, _VOWELS, _TAILS = 19, 21, 28
# Private characters that stand for combining classes.
_CLASS_BASE = 0xE000
# Different clusters of a text that are composed once each and then looked up.
_MANY = 1000


def _canonical(char: str) -> str:
    """The canonical decomposition in one step; empty if there is none."""
    parts = unicodedata.decomposition(char)
    return "" if not parts or parts.startswith("<") else "".join(chr(int(p, 16)) for p in parts.split())


def _char_class(chars: Iterable[str]) -> str:
    """Ranges for a regex class."""
    ranges: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "".join(f"\\x{{{first:x}}}-\\x{{{last:x}}}" for first, last in ranges)


_ALL = [c for c in map(chr, range(0x300, sys.maxunicode + 1)) if not "\ud800" <= c <= "\udfff"]
_MARKS = [c for c in _ALL if unicodedata.combining(c)]
# Some Tibetan vowel signs count as starters, but fall apart into marks alone.
_LOOSE = [c for c in _ALL if unicodedata.combining(unicodedata.normalize("NFD", c)[0])]
_STEPS = {c: _canonical(c) for c in map(chr, range(0xC0, sys.maxunicode + 1)) if _canonical(c)}
_PAIRS = {parts: c for c, parts in _STEPS.items() if len(parts) == 2 and unicodedata.normalize("NFC", c) == c}
# Starters that may be composed with the character before them.
_SECONDS = {p[1] for p in _PAIRS if not unicodedata.combining(p[1])} | {
    *map(chr, range(_VOWEL, _VOWEL + _VOWELS)),
    *map(chr, range(_TAIL + 1, _TAIL + _TAILS)),
}
_UNSTABLE = [c for c in _STEPS if unicodedata.normalize("NFC", c) != c and c not in _LOOSE]

_M, _S, _X = _char_class(_LOOSE), _char_class(_SECONDS), _char_class(_UNSTABLE)
# All of them lie beyond Latin letters, which one cheap test lets pass.
_CHANGEABLE = rf"(?=[\x{{300}}-\x{{10ffff}}])[{_M}{_S}{_X}]"
_NO_MARK = rf"[\x00-\x{{2ff}}[^{_M}]]"
# A class of many ranges asks each of them, so the scan over a whole text asks for the block of a character first. All
# characters up to U+034E are marks.
_MARK = rf"[\x{{300}}-\x{{34e}}[\x{{350}}-\x{{10ffff}}&&[{_M}]]]"
_SECOND = rf"[\x{{370}}-\x{{10ffff}}&&[{_S}]]"
_CLUSTER = rf"{_NO_MARK}(?:{_SECOND}{{1,2}}{_MARK}*+|{_MARK}++)|(?=[\x{{300}}-\x{{10ffff}}])[{_X}]|{_MARK}++"
_PLAIN = rf"[\x00-\x{{2ff}}[\x{{370}}-\x{{10ffff}}&&[^{_M}{_S}{_X}]]]+(?!{_MARK}|{_SECOND})"
_PIECE = rf"{_CLUSTER}|{_PLAIN}|{_NO_MARK}"
_SEGMENT = rf"{_NO_MARK}[{_M}]*+|[{_M}]++"

# Longest decompositions first: translate drops characters that its second list is too short for.
_FULL = dict(sorted(((c, unicodedata.normalize("NFD", c)) for c in _STEPS), key=lambda item: -len(item[1])))
_WHOLE = "".join(_FULL)
_PLACES = ["".join(parts[k] for parts in _FULL.values() if len(parts) > k) for k in range(max(map(len, _FULL.values())))]

_BY_SECOND: dict[str, dict[str, str]] = defaultdict(dict)
for _parts, _composed in _PAIRS.items():
    _BY_SECOND[_parts[1]][_parts[0]] = _composed
_FIRSTS = {second: "".join(found) for second, found in _BY_SECOND.items()}
_COMPOSED = {second: "".join(found.values()) for second, found in _BY_SECOND.items()}


# The expression is written as SQL and kept, as it would take long to build anew for each use.
def _lit(text: str) -> str:
    return f"r'{text}'"


def _let(name: str, value: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _map(values: dict[str, str]) -> str:
    return f"str_to_map({_lit(';'.join(f'{k}:{v}' for k, v in values.items()))}, ';', ':')"


def _decomposed(c: str) -> str:
    first, *others = (f"translate({c}, {_lit(_WHOLE)}, {_lit(place)})" for place in _PLACES)
    return _let("d", first, f"if(d = {c}, {c}, concat(d, {', '.join(others)}))")


def _combining_class(c: str) -> str:
    ranks = "".join(chr(_CLASS_BASE + unicodedata.combining(m)) for m in _MARKS)
    shown = f"translate({c}, {_lit(''.join(_MARKS))}, {_lit(ranks)})"
    return _let("d", shown, f"if(d = {c}, 0, ascii(d) - {_CLASS_BASE})")


def _syllable(first: str, second: str) -> str:
    """Hangul lead and vowel, or syllable without tail and tail; else NULL."""
    a, b = f"ascii({first})", f"ascii({second})"
    last = _SYLLABLE + _LEADS * _VOWELS * _TAILS - 1
    code = f"""CASE
      WHEN {a} BETWEEN {_LEAD} AND {_LEAD + _LEADS - 1} AND {b} BETWEEN {_VOWEL} AND {_VOWEL + _VOWELS - 1}
        THEN {_SYLLABLE} + (({a} - {_LEAD}) * {_VOWELS} + {b} - {_VOWEL}) * {_TAILS}
      WHEN {a} BETWEEN {_SYLLABLE} AND {last} AND ({a} - {_SYLLABLE}) % {_TAILS} = 0
        AND {b} BETWEEN {_TAIL + 1} AND {_TAIL + _TAILS - 1} THEN {a} + {b} - {_TAIL} END"""
    return f"decode(unhex(hex({code})), 'UTF-16BE')"


def _joined(first: str, second: str) -> str:
    """The one character two compose to; else NULL."""
    place = f"position({first}, try_element_at({_map(_FIRSTS)}, {second}))"
    found = f"if(p > 0, substr(try_element_at({_map(_COMPOSED)}, {second}), p, 1), NULL)"
    return f"if({first} = '', NULL, coalesce({_let('p', place, found)}, {_syllable(first, second)}))"


def _state(n: str, at: str, starter: str, last: str, edits: str) -> str:
    return f"named_struct('n', {n}, 'at', {at}, 'starter', {starter}, 'last', {last}, 'edits', {edits})"


def _edited(at: str, text: str) -> str:
    return f"concat(s.edits, array(named_struct('at', {at}, 'text', {text})))"


def _compose_cluster(cluster: str) -> str:
    """Decompose, order and compose one cluster.

    The fold keeps the current starter and the few places that change, not the text, so long runs of marks stay linear.
    """
    apart = f"array_join(transform(regexp_extract_all({cluster}, r'(?s).', 0), c -> {_decomposed('c')}), '')"
    ranked = f"(c, i) -> named_struct('rank', {_combining_class('c')}, 'i', i, 'c', c)"
    ordered = f"""flatten(transform(regexp_extract_all({apart}, {_lit(_SEGMENT)}, 0),
      segment -> array_sort(transform(regexp_extract_all(segment, r'(?s).', 0), {ranked}))))"""
    step = _let(
        "whole",
        f"if(s.last < 0 OR s.last < x.rank, {_joined('s.starter', 'x.c')}, NULL)",
        f"""CASE WHEN whole IS NOT NULL THEN {_state('s.n + 1', 's.at', 'whole', 's.last', _edited('s.n', "''"))}
          WHEN x.rank = 0 THEN {_state('s.n + 1', 's.n', 'x.c', '-1', _edited('s.at', 's.starter'))}
          ELSE {_state('s.n + 1', 's.at', 's.starter', 'x.rank', 's.edits')} END""",
    )
    begin = _state("0", "-1", "''", "-1", "cast(array() AS array<struct<at:int,text:string>>)")
    edits = f"aggregate(parts, {begin}, (s, x) -> {step}, s -> {_edited('s.at', 's.starter')})"
    shown = "transform(parts, (x, i) -> coalesce(get(filter(edits, e -> e.at = i), 0).text, x.c))"
    return _let("parts", ordered, _let("edits", edits, f"array_join({shown}, '')"))


@cache
def _body(context: SparkContext) -> Column:
    """The lambda from a text to its composed form; kept once per context."""
    changeable = _lit(_CHANGEABLE)
    different = f"filter(array_distinct(pieces), piece -> rlike(piece, {changeable}))"
    formed = f"transform(keys, piece -> if(rlike(piece, {changeable}), {_compose_cluster('piece')}, piece))"
    found = _let("known", "map_from_arrays(keys, formed)", "transform(pieces, piece -> coalesce(try_element_at(known, piece), piece))")
    # a look-up passes over the whole map, so a text of very many different clusters has each of its pieces composed
    whole = _let("formed", formed, f"array_join(if(many, formed, {found}), '')")
    keyed = _let("keys", "if(many, pieces, different)", whole)
    chosen = _let("different", different, _let("many", f"size(different) > {_MANY}", keyed))
    composed = _let("pieces", f"regexp_extract_all(t, {_lit(_PIECE)}, 0)", chosen)
    return F.expr(f"t -> if(rlike(t, {changeable}), {composed}, t)")


def compose_unicode(text: Column) -> Column:
    """The text in Unicode's composed normal form (NFC); NULL stays NULL."""
    return F.element_at(F.call_function("transform", F.array(text), _body(SparkContext.getOrCreate())), 1)
