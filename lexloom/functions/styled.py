"""Styled text: markup to normalised text with style runs, and edit tokens from styles.

A document is its text and run-length encoded styles: (start, end, bold, underline) over code points, 0-based and
half-open, so text and offsets always come from one pass and can't drift apart.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from html import escape, unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

Run = tuple[int, int, bool, bool]

#: Tags that break lines, tags without content, tags whose content is hidden (fixed values).
BREAKS = frozenset(("p", "div", "br", "h1", "h2", "li", "tr"))
EMPTY = frozenset(("br", "meta", "link", "img", "hr", "input"))
HIDDEN = frozenset(("script", "style"))
_HEAVY = re.compile(r"font-weight\s*:\s*(?:bold|[7-9]00)")
_WORD = re.compile(r"\w+(?:['’]\w+)*|[^\w\s]")
_PARTS = re.compile(r"\s+|\S+")
_LINE_HYPHEN = re.compile(r"(?<=[A-Za-z])-\n(?=[a-z])")
_PARAGRAPH = re.compile(r"\d+[A-Z]?\.\d{3,4}\s|Notes?:|Chapter\s|\d{4}\s+EDITION")


class _Reader(HTMLParser):
    """Collects (text, bold, underline) pieces; counters per open element keep it linear in the depth of nesting."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, bool]] = []
        self.pieces: list[tuple[str, bool, bool]] = []
        self.bold = self.underline = self.hidden = 0

    def _shift(self, element: tuple[str, bool, bool], by: int) -> None:
        self.bold += by * element[1]
        self.underline += by * element[2]

    def handle_starttag(self, tag, attrs):
        css = (dict(attrs).get("style") or "").lower()
        self.hidden += tag in HIDDEN
        if tag not in EMPTY:
            element = (tag, tag in ("b", "strong") or bool(_HEAVY.search(css)), tag in ("u", "ins") or "underline" in css)
            self.open.append(element)
            self._shift(element, 1)
        if tag in BREAKS:
            self.pieces.append(("\n", False, False))

    def handle_endtag(self, tag):
        if tag in HIDDEN and self.hidden:
            self.hidden -= 1
        if any(e[0] == tag for e in self.open):
            while True:
                element = self.open.pop()
                self._shift(element, -1)
                if element[0] == tag:
                    break
        if tag in BREAKS and tag != "br":
            self.pieces.append(("\n", False, False))

    def handle_data(self, data):
        if not self.hidden:
            self.pieces.append((data, self.bold > 0, self.underline > 0))


def styles_of(length: int, runs: list[Run]) -> list[tuple[bool, bool]]:
    out = [(False, False)] * length
    for start, end, bold, underline in runs:
        out[start:end] = [(bold, underline)] * (end - start)
    return out


def normalized(pieces: list[tuple[str, bool, bool]]) -> tuple[str, list[Run]]:
    """NFKC text without soft hyphens, white space collapsed (a line break wins), line-end hyphens joined.

    Pieces are cut into words and gaps, gaps that meet become one, and runs follow from the parts' lengths; what the
    joined hyphens take away is then taken from the runs' offsets.
    """
    parts: list[tuple[str, tuple[bool, bool]]] = []
    for text, bold, underline in pieces:
        for part in _PARTS.findall(unicodedata.normalize("NFKC", text).replace("\xad", "")):
            here = part, (bold, underline)
            if part.isspace():
                here = "\n" if "\n" in part else " ", (bold, underline)
                if parts and parts[-1][0] in ("\n", " "):
                    last = parts.pop()
                    here = max(here[0], last[0], key=" \n".index), last[1]
            parts.append(here)
    text = "".join(part for part, _ in parts)
    gone = [i for m in _LINE_HYPHEN.finditer(text) for i in range(*m.span())]
    runs: list[Run] = []
    at = 0
    for part, style in parts:
        start, at = at, at + len(part)
        begin, end = (x - bisect_left(gone, x) for x in (start, at))
        if any(style) and end > begin:
            joined = runs and runs[-1][1] == begin and runs[-1][2:] == style
            runs.append((runs.pop()[0] if joined else begin, end, *style))
    return _LINE_HYPHEN.sub("", text), runs


def read_html(markup: str) -> tuple[str, list[Run]]:
    """Markup to normalised text and style runs."""
    reader = _Reader()
    reader.feed(markup)
    reader.close()
    return normalized(reader.pieces)


def slice_runs(runs: list[Run], start: int, end: int) -> list[Run]:
    """Runs of text[start:end] with shifted offsets."""
    return [(max(a, start) - start, min(b, end) - start, bold, underline) for a, b, bold, underline in runs if a < end and b > start]


def to_markup(text: str, runs: list[Run]) -> str:
    """Minimal <p>/<b> markup: paragraphs where a section or note starts, other line breaks as spaces (T4)."""
    bold = [s[0] for s in styles_of(len(text), runs)]
    out, on = ["<p>"], False
    for i, c in enumerate(text):
        if c == "\n":
            if _PARAGRAPH.match(text, i + 1):
                out.append(("</b>" if on else "") + "</p><p>")
                on = False
            else:
                out.append(" ")
        else:
            if bold[i] != on:
                on = bold[i]
                out.append("<b>" if on else "</b>")
            out.append(escape(c))
    return "".join(out) + ("</b>" if on else "") + "</p>"


class UnbalancedBrackets(ValueError):
    """A deletion bracket without its partner."""


def edit_tokens(text: str, runs: list[Run]) -> list[tuple[str, str, int, int]]:
    """(operation, text, start, end): KEEP, ADD (styled), DELETE (inside brackets) or MARKER (the brackets).

    A word whose style changes within is split there, so both spellings can be read off. Unbalanced brackets raise.
    """
    styled = [any(s) for s in styles_of(len(text), runs)]
    out: list[tuple[str, str, int, int]] = []
    depth = 0
    for m in _WORD.finditer(text):
        start, end = m.span()
        if m[0] in "[]":
            depth += 1 if m[0] == "[" else -1
            if depth < 0:
                raise UnbalancedBrackets(f"closing bracket at {start}")
            out.append(("MARKER", m[0], start, end))
        elif depth:
            out.append(("DELETE", m[0], start, end))
        else:
            edges = [start, *(i for i in range(start + 1, end) if styled[i] != styled[i - 1]), end]
            out += [("ADD" if styled[a] else "KEEP", text[a:b], a, b) for a, b in zip(edges, edges[1:], strict=False)]
    if depth:
        raise UnbalancedBrackets("bracket left open")
    return out


_RUN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("bold", T.BooleanType()), T.StructField("underline", T.BooleanType())])
STYLED = T.StructType([T.StructField("text", T.StringType()), T.StructField("runs", T.ArrayType(_RUN))])
_RUN_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("bold", pa.bool_()), ("underline", pa.bool_())]))
_STYLED_ARROW = pa.struct([("text", pa.string()), ("runs", _RUN_ARROW)])
_TOKEN = T.StructType([T.StructField("operation", T.StringType()), T.StructField("text", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
TOKENS = T.StructType([T.StructField("ok", T.BooleanType()), T.StructField("error", T.StringType()), T.StructField("tokens", T.ArrayType(_TOKEN))])
_TOKENS_ARROW = pa.struct([("ok", pa.bool_()), ("error", pa.string()), ("tokens", pa.list_(pa.struct([("operation", pa.string()), ("text", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))])


@F.arrow_udf(STYLED)
def html_styled(markup: pa.Array) -> pa.Array:
    """Markup -> struct text, runs; null gives null."""

    def one(value):
        if value is None:
            return None
        text, runs = read_html(value)
        return {"text": text, "runs": [dict(zip(("start", "end", "bold", "underline"), r, strict=True)) for r in runs]}

    return pa.array((one(x.as_py()) for x in markup), _STYLED_ARROW)


@F.arrow_udf(TOKENS)
def tokens_udf(styled: pa.Array) -> pa.Array:
    """struct text, runs -> struct ok, error, tokens: one bad document gives a diagnostic and fails no job."""

    def one(value):
        if value is None:
            return None
        try:
            found = edit_tokens(value["text"], [(r["start"], r["end"], r["bold"], r["underline"]) for r in value["runs"]])
        except UnbalancedBrackets as error:
            return {"ok": False, "error": str(error), "tokens": []}
        return {"ok": True, "error": None, "tokens": [dict(zip(("operation", "text", "start", "end"), t, strict=True)) for t in found]}

    return pa.array((one(x.as_py()) for x in styled), _TOKENS_ARROW)


@F.arrow_udf(T.StringType())
def html_text(text: pa.Array) -> pa.Array:
    """All character references replaced."""
    return pa.array((None if (v := x.as_py()) is None else unescape(v) for x in text), pa.string())


@F.arrow_udf(T.StringType())
def nfkc(text: pa.Array) -> pa.Array:
    """NFKC-normalised text."""
    return pa.array((None if (v := x.as_py()) is None else unicodedata.normalize("NFKC", v) for x in text), pa.string())


DECODED = T.StructType([T.StructField("text", T.StringType()), T.StructField("encoding", T.StringType())])
_CHARSET = re.compile(rb"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)


def decode_bytes(raw: bytes) -> tuple[str, str]:
    """Text and encoding: the declared one, then UTF-8, then Windows-1252, else UTF-8 with replacements."""
    declared = _CHARSET.search(raw[:8192])
    for name in ([declared[1].decode().lower()] if declared else []) + ["utf-8", "cp1252"]:
        try:
            return raw.decode(name), name
        except (LookupError, UnicodeDecodeError):
            continue
    return raw.decode("utf-8", "replace"), "utf-8-replace"


@F.arrow_udf(DECODED)
def decoded(raw: pa.Array) -> pa.Array:
    """Bytes -> struct text, encoding."""
    rows = (None if (v := x.as_py()) is None else dict(zip(("text", "encoding"), decode_bytes(v), strict=True)) for x in raw)
    return pa.array(rows, pa.struct([("text", pa.string()), ("encoding", pa.string())]))


def find_spans_udf(pattern: str, flags: int = 0):
    """Arrow UDF text -> array of struct match, start, end, groups: regular-expression matches with their offsets."""
    compiled = re.compile(pattern, flags)
    kind = pa.list_(pa.struct([("match", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("groups", pa.list_(pa.string()))]))
    spark = T.ArrayType(T.StructType([T.StructField("match", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("groups", T.ArrayType(T.StringType()))]))

    @F.arrow_udf(spark)
    def find_spans(text: pa.Array) -> pa.Array:
        rows = ([{"match": m[0], "start": m.start(), "end": m.end(), "groups": list(m.groups())} for m in compiled.finditer(x.as_py() or "")] for x in text)
        return pa.array(rows, kind)

    return find_spans
