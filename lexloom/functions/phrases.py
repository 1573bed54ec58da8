"""Phrases over words: a text as tokens with offsets, and templates that are matched against them.

A template is words parted by spaces. ``a|b`` is either word; ``{section}``, ``{number}``, ``{year}`` and ``{count}`` are
kinds of tokens; ``...`` is the shortest run of one token or more up to what follows; ``~word`` is a word in any case.
White space between tokens never counts.
"""

from __future__ import annotations

import re
from functools import cache
from typing import NamedTuple

SECTION = r"\d{1,3}[A-Z]?\.\d{3,4}"
_TOKEN = re.compile(rf"{SECTION}(?!\d)|\w+|[^\w\s]")
_KINDS = {"{section}": re.compile(SECTION), "{number}": re.compile(r"\d+[A-Za-z]?"), "{count}": re.compile(r"\d+"), "{year}": re.compile(r"(?:18|19|20|21)\d\d")}


class Token(NamedTuple):
    text: str
    start: int
    end: int


class Match(NamedTuple):
    """The token behind the match, and the token ranges of its kinds and gaps in order."""

    end: int
    parts: tuple[tuple[int, int], ...]


def tokens_of(text: str) -> list[Token]:
    return [Token(m[0], m.start(), m.end()) for m in _TOKEN.finditer(text)]


@cache
def _elements(template: str) -> tuple[str, ...]:
    return tuple(template.split())


def _fits(element: str, token: str) -> bool:
    if element in _KINDS:
        return bool(_KINDS[element].fullmatch(token))
    if element.startswith("~"):
        element, token = element[1:].lower(), token.lower()
    return token == element or token in element.split("|")


def match(template: str, tokens: list[Token], at: int = 0) -> Match | None:
    """The template from token ``at`` on, each gap as short as can be."""
    elements, parts, gap = _elements(template), [], None
    i = 0
    while i < len(elements):
        if elements[i] == "...":
            gap = (i, at, at + 1)
            at, i = at + 1, i + 1
            parts.append((at - 1, at))
        elif at < len(tokens) and _fits(elements[i], tokens[at].text):
            if elements[i] in _KINDS:
                parts.append((at, at + 1))
            at, i = at + 1, i + 1
        elif gap and at < len(tokens):
            # widen the last gap by one token and try what follows it again
            i, first, upto = gap[0] + 1, gap[1], gap[2] + 1
            parts = parts[: sum(e == "..." or e in _KINDS for e in elements[: gap[0]])] + [(first, upto)]
            gap, at = (gap[0], first, upto), upto
        else:
            return None
        if at > len(tokens):
            return None
    return Match(at, tuple(parts))
