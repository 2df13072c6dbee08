"""Markup that the standard parser reads in one pass."""

from __future__ import annotations

import re
from collections.abc import Iterable

_COMMENT_END = re.compile(r"--\s*>")
_SECTION_END = re.compile(r"\]\s*>")
_DATA_END = re.compile(r"\]\s*\]\s*>")
_SECTION = re.compile(r"<!\[([a-zA-Z][-_.a-zA-Z0-9]*)?")
#: Keywords of marked sections that the standard parser knows, by how they end; fixed values.
_DATA_SECTIONS = frozenset(("temp", "cdata", "ignore", "include", "rcdata"))
_CONDITIONS = frozenset(("if", "else", "endif"))


def _last(found: Iterable[re.Match]) -> int:
    """Where the last match starts; -1 without one."""
    at = -1
    for match in found:
        at = match.start()
    return at


def _as_text(page: str, start: int) -> tuple[str, int]:
    """The page's text from an opening that nothing ends, up to and with the next ``>``, and where that is."""
    end = page.find(">", start) + 1
    return page[start:end].replace("<", "&lt;"), end


def one_pass(page: str) -> str:
    """The page for ``html.parser``, which gives the same text and tags for it, but reads each character a bounded number of times.

    Left alone, that parser seeks the end of every tag, comment and marked section up to the end of the page, also where
    there is none; it then takes the opening for text, up to the next ``>``. Here such openings are written as text to begin
    with. A marked section of an unknown kind, on which it fails, becomes a comment, as in browsers.
    """
    last = page.rfind(">") + 1
    head, tail = page[:last], page[last:].replace("<", "&lt;")
    if "<!--" not in head and "<![" not in head:
        return head + tail
    comment_end, section_end, data_end = (_last(p.finditer(head)) for p in (_COMMENT_END, _SECTION_END, _DATA_END))
    parts, at = [], 0
    for match in re.finditer(r"<!--|<!\[", head):
        start = match.start()
        if start < at:
            continue
        if match[0] == "<!--":
            whole = start + 4 <= comment_end
            if whole:
                # nothing opens within a comment
                end = _COMMENT_END.search(head, start + 4).end()
                parts.append(head[at:end])
                at = end
                continue
        else:
            name = (_SECTION.match(head, start)[1] or "").lower()
            if name not in _DATA_SECTIONS | _CONDITIONS:
                parts += [head[at:start], "<! "]
                at = start + 2
                continue
            whole = start + 3 <= (data_end if name in _DATA_SECTIONS else section_end)
        if not whole:
            text, end = _as_text(head, start)
            parts += [head[at:start], text]
            at = end
    parts += [head[at:], tail]
    return "".join(parts)
