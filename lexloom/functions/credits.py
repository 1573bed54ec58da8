"""Source credits: where a section comes from, as printed in brackets after it.

A credit is a list of segments parted by semicolons. A segment is read as words by a small grammar:

    segment   = other | citation [("and" ["by"] | own action) citation]
    citation  = [action "by" | "derived from" | part "enacted as"] year [session] "c." number [sections] [parenthesis]
    other     = "formerly" [part "of"] section | ("renumbered" | "enacted in lieu of") section [in year]
              | part "renumbered" section {"and" part "renumbered" section} [in year]
    part      = "subsection(s)" parenthesis ["to" parenthesis]

What fits none of it is kept as it is.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.functions.phrases import SECTION

#: What an action word states (fixed values).
ACTIONS = {"amended": "amended", "amendments": "amended", "repealed": "repealed", "renumbered": "renumbered", "reenacted": "enacted"}
_TOKEN = re.compile(rf"(?P<section>{SECTION})|(?P<number>\d+(?:[a-z](?![A-Za-z.]))?)|(?P<word>[A-Za-z]+)|(?P<paren>\([^)]*\))|(?P<mark>§+|[.,])|(?P<odd>\S)")


@dataclass
class Credit:
    citations: list[dict] = field(default_factory=list)
    formerly: list[str] = field(default_factory=list)
    renumbered: list[str] = field(default_factory=list)
    in_lieu: list[str] = field(default_factory=list)
    unparsed: list[str] = field(default_factory=list)


class _Misfit(Exception):
    """The words are none of the grammar's."""


class _Reader:
    """Reads one segment's tokens from left to right; methods raise _Misfit where what must come does not."""

    def __init__(self, text: str):
        self.tokens = [(m.lastgroup, m[0], m.start(), m.end()) for m in _TOKEN.finditer(text)]
        self.at = 0

    def _peek(self, ahead: int = 0) -> tuple[str, str]:
        at = self.at + ahead
        return self.tokens[at][:2] if at < len(self.tokens) else ("end", "")

    def done(self) -> bool:
        return self.at == len(self.tokens)

    def begin(self) -> int:
        return self.tokens[self.at][2] if not self.done() else 0

    def end(self) -> int:
        return self.tokens[self.at - 1][3]

    def says(self, *words: str) -> bool:
        """Takes these words, in any case, if they come next."""
        if all(self._peek(i)[1].lower() == w for i, w in enumerate(words)):
            self.at += len(words)
            return True
        return False

    def take(self, kind: str, fits: str = "") -> str:
        found, text = self._peek()
        if found != kind or fits and not re.fullmatch(fits, text):
            raise _Misfit(kind)
        self.at += 1
        return text

    def has(self, kind: str, fits: str = "") -> bool:
        found, text = self._peek()
        return found == kind and (not fits or bool(re.fullmatch(fits, text)))

    def must(self, *words: str) -> None:
        if not self.says(*words):
            raise _Misfit(" ".join(words))

    def part(self) -> bool:
        """A part of a section, if one comes next."""
        if not (self.says("subsections") or self.says("subsection")):
            return False
        self.take("paren")
        if self.says("to"):
            self.take("paren")
        return True

    def year(self) -> int:
        return int(self.take("number", r"(?:18|19|20)\d\d"))

    def ends_in_year(self) -> None:
        if self.says("in"):
            self.year()
        if not self.done():
            raise _Misfit("more")

    def sections(self) -> list[str | None]:
        """Numbers of a list; a part without a number belongs to the one before."""
        numbers: list[str | None] = []
        while True:
            if self.has("number"):
                numbers.append(self.take("number"))
            while self.has("paren", r"\(\d+[a-z]?\)"):
                self.take("paren")
            if not self.says(","):
                return numbers or [None]

    def citation(self, inherited: str | None) -> tuple[str, list[dict], bool]:
        """Action, rows, and whether the action is a word of the citation's own."""
        action, own = inherited or "unspecified", False
        if self.says("derived", "from"):
            action = "enacted"
        elif self.part():
            self.must("enacted", "as")
            action = "enacted"
        elif self._peek()[1].lower() in ACTIONS:
            action, own = ACTIONS[self.take("word").lower()], True
            self.must("by")
        row = {"action": action, "session_year": self.year(), "special_session": None}
        if self.says("s", ".", "s", "."):
            row["special_session"] = int(self.take("number", r"\d+")) if self.has("number", r"\d+") else 1
        else:
            self.says("cor", ".")
        self.must("c", ".")
        row["session_law_chapter"] = int(self.take("number", r"\d+"))
        numbers: list[str | None] = [None]
        if self.says("§") or self.says("§§") or self.says("s", "."):
            numbers = self.sections()
        if self.has("paren"):
            self.take("paren")
        return action, [row | {"session_law_section": n} for n in numbers], own


def _citations(segment: str) -> list[dict]:
    """The rows of one citation or two, a second one having a join or an action word before it."""
    words = _Reader(segment)
    action, first, _ = words.citation(None)
    if words.done():
        return [c | {"raw_segment": segment} for c in first]
    rows = [c | {"raw_segment": segment[: words.end()].strip()} for c in first]
    joined = words.says("and")
    begin = words.begin()
    _, second, own = words.citation(action if joined and words.says("by") else None)
    if not words.done() or not (joined or own):
        raise _Misfit("second citation")
    return rows + [c | {"raw_segment": segment[begin:].strip()} for c in second]


def _others(segment: str) -> tuple[str, list[str]]:
    """The kind of a segment that names sections, and the sections."""
    words = _Reader(segment)
    if words.says("formerly"):
        if words.part():
            words.must("of")
        found = "formerly", [words.take("section")]
        if not words.done():
            raise _Misfit("more")
        return found
    if words.says("renumbered") or words.says("enacted", "in", "lieu", "of"):
        found = "in_lieu" if words.at > 1 else "renumbered", [words.take("section")]
        words.ends_in_year()
        return found
    moved = []
    while not moved or words.says("and"):
        if not words.part():
            raise _Misfit("part")
        words.must("renumbered")
        moved.append(words.take("section"))
    words.ends_in_year()
    return "renumbered", moved


def parse_credit(raw: str | None) -> Credit:
    """A printed credit's parts."""
    body = (raw or "").strip()
    if body.startswith("[") and body.endswith("]"):
        body = body[1:-1]
    out = Credit()
    for segment in filter(None, map(str.strip, body.split(";"))):
        for read in (_others, _citations):
            try:
                found = read(segment)
            except _Misfit:
                continue
            if read is _others:
                getattr(out, found[0]).extend(found[1])
            else:
                out.citations.extend(found)
            break
        else:
            out.unparsed.append(segment)
    return out


_CITE = [("action", "string"), ("session_year", "int"), ("special_session", "int"), ("session_law_chapter", "int"), ("session_law_section", "string"), ("raw_segment", "string")]
_ARROW = {"string": pa.string(), "int": pa.int32()}
_KIND = pa.struct([("citations", pa.list_(pa.struct([(n, _ARROW[t]) for n, t in _CITE]))), *((n, pa.list_(pa.string())) for n in ("formerly", "renumbered", "in_lieu", "unparsed"))])
_SPARK = {"string": T.StringType(), "int": T.IntegerType()}
_CITATIONS = T.ArrayType(T.StructType([T.StructField(n, _SPARK[t]) for n, t in _CITE]))
CREDIT = T.StructType([T.StructField("citations", _CITATIONS), *(T.StructField(n, T.ArrayType(T.StringType())) for n in ("formerly", "renumbered", "in_lieu", "unparsed"))])


@F.arrow_udf(CREDIT)
def credit_udf(raw: pa.Array) -> pa.Array:
    """Printed credit -> struct citations, formerly, renumbered, in_lieu, unparsed."""
    return pa.array((vars(parse_credit(x.as_py())) for x in raw), _KIND)
