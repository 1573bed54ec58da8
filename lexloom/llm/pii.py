"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust their score.

Base kinds (email, ip, card, phone) are decided by pattern and validator alone and always stay. Further kinds start
from a score that a checksum (IBAN: its country's length and mod-97) or words close to the span (a national phone
number, a social security number, a date of birth, a passport number) raise, and that words of other numbers close
before it lower; a span is reported at ``threshold`` or more.

One pass per document, no shuffle. Every pattern is linear on long runs: no start within a run is tried twice.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm._shared import small_batches, table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "phone_local", "birth_date", "passport")
THRESHOLD = 0.6
#: Characters before and after a span in which words count as its context, and before it as a sign of another number.
REACH, REACH_AFTER, REACH_AGAINST = 40, 20, 15

# The domain is searched for and the local part read backwards from it: the same leftmost match, without restarts.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match that could begin within a run of digits could begin at its start too.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])([A-Z]{2})[0-9]{2}(?= ?[A-Z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])(?:\([0-9]{2,5}\) ?|0)[0-9][0-9 ./-]{4,14}[0-9](?![0-9])")
_BIRTH = re.compile(r"(?<![0-9])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4})(?![0-9])")
_PASSPORT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{1,2}[0-9]{6,8}(?![A-Za-z0-9])")
_DIGITS = re.compile(r"[0-9]")
#: Context words by kind (fixed values).
_CONTEXT = {
    "iban": re.compile(r"iban|bank|account|konto|compte|cuenta", re.I),
    "ssn": re.compile(r"ssn|social security|tax id", re.I),
    "phone_local": re.compile(r"phone|tel\b|tel[.:]|call|mobile|fax|telefon|téléphone|teléfono|handy", re.I),
    "birth_date": re.compile(r"born|birth|dob|geboren|geburt|naissance|né le|née le|nacimiento|nacid", re.I),
    "passport": re.compile(r"passport|reisepass|passeport|pasaporte", re.I),
}


#: Words of other numbers (fixed values), and what they take from a score.
_AGAINST, AGAINST = re.compile(r"order|invoice|isbn|version|serial|sku|article|model|ticket|tracking|bestell|rechnung|facture|pedido|factura", re.I), 0.4
#: Length of an IBAN by country (fixed values of the public IBAN registry).
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24,
    "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27,
    "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28,
    "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28,
    "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}
_IBAN_REST = {n: re.compile(rf"(?: ?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])") for n in set(IBAN_LENGTHS.values())}


@dataclass(frozen=True, order=True)
class Span:
    start: int
    order: int
    end: int
    score: float

    @property
    def kind(self) -> str:
        return KINDS[self.order]


def luhn(digits: str) -> bool:
    """Whether a number's last digit is its Luhn check digit."""
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an IBAN without spaces passes ISO 7064 mod-97."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            free = m.end()
            yield start, free


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def base_spans(text: str) -> list[Span]:
    """The contract's spans, by start and then kind as listed."""
    found = [Span(a, 0, b, 1.0) for a, b in _emails(text)]
    if _DIGITS.search(text):
        found += [Span(m.start(), 1, m.end(), 1.0) for m in _IP.finditer(text) if all(len(x.lstrip("0")) < 4 and int(x) <= 255 for x in m[0].split("."))]
        found += [Span(a, 2, b, 1.0) for a, b in _cards(text)]
        found += [Span(m.start(), 3, m.end(), 1.0) for m in _PHONE.finditer(text) if 10 <= len(_DIGITS.findall(m[0])) <= 15]
    return sorted(found)


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Spans of a country's IBAN length that pass the checksum, whatever stands behind them."""
    free = 0
    for m in _IBAN.finditer(text):
        rest = _IBAN_REST[IBAN_LENGTHS[m[1]]].match(text, m.end()) if m[1] in IBAN_LENGTHS and m.start() >= free else None
        if rest and mod97(text[m.start() : rest.end()].replace(" ", "")):
            free = rest.end()
            yield m.start(), free


def _proposed(text: str) -> Iterator[tuple[str, int, int, float]]:
    """Spans of the further kinds with their score before context."""
    for span in _ibans(text):
        yield "iban", *span, 0.7
    for m in _SSN.finditer(text):
        area, group, serial = m[0].split("-")
        issued = area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"
        yield "ssn", *m.span(), 0.4 if issued else 0.0
    for m in _LOCAL_PHONE.finditer(text):
        yield "phone_local", *m.span(), 0.3 if 7 <= len(_DIGITS.findall(m[0])) <= 12 else 0.0
    for m in _BIRTH.finditer(text):
        yield "birth_date", *m.span(), 0.2
    for m in _PASSPORT.finditer(text):
        yield "passport", *m.span(), 0.2


def find_spans(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """Base spans and those further ones that score ``threshold`` or more and overlap no base span."""
    base = base_spans(text)
    if not _DIGITS.search(text):
        return base
    starts = [x.start for x in base]
    reached = list(accumulate((x.end for x in base), max))
    more = []
    for kind, start, end, score in _proposed(text):
        near = _CONTEXT[kind].search
        if score and (near(text, max(0, start - REACH), start) or near(text, end, end + REACH_AFTER)):
            score = min(1.0, score + 0.5)
        if kind != "iban" and _AGAINST.search(text, max(0, start - REACH_AGAINST), start):
            score -= AGAINST
        before = bisect_left(starts, end)
        if score >= threshold and not (before and reached[before - 1] > start):
            more.append(Span(start, KINDS.index(kind), end, score))
    return sorted(base + more)


def printed(spans: list[Span]) -> str:
    return ",".join(f"{x.kind}:{x.start}:{x.end}" for x in spans)


def redact(text: str, spans: list[Span]) -> str:
    """text with each span, overlapping ones together, replaced by the first one's kind in angle brackets."""
    out, at = [], 0
    for x in spans:
        if x.start >= at:
            out += [text[at : x.start], f"<{x.kind}>"]
        at = max(at, x.end)
    return "".join(out) + text[at:]


_SPAN_TYPE = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]))
_SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def spans_udf(threshold: float = THRESHOLD):
    """Arrow UDF text -> array of struct kind, start, end (code points, end exclusive), score."""

    @F.arrow_udf(_SPAN_TYPE)
    def spans(text: pa.Array) -> pa.Array:
        rows = ([{"kind": s.kind, "start": s.start, "end": s.end, "score": s.score} for s in find_spans(x.as_py() or "", threshold)] for x in text)
        return pa.array(rows, _SPAN_ARROW)

    return spans


def redact_udf(threshold: float = THRESHOLD):
    """Arrow UDF text -> text without personal data; null stays null."""

    @F.arrow_udf(T.StringType())
    def redacted(text: pa.Array) -> pa.Array:
        values = (x.as_py() for x in text)
        return pa.array((v if v is None else redact(v, find_spans(v, threshold)) for v in values), pa.string())

    return redacted


def detect_pii(docs: DataFrame, threshold: float = THRESHOLD, name: str = "pii") -> DataFrame:
    """docs with a column ``name``, in place of one so named: array of struct(kind, start, end, score).

    Null and empty texts have none; every row stays, repeated ones too, and so do other columns; an empty table stays so.
    """
    small_batches(docs.sparkSession)
    return docs.withColumn(name, spans_udf(threshold)("text"))


def redact_pii(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs with personal data in text replaced by its kind; n_chars, where there is one, counts the new text.

    Every row stays, repeated ones too, and so do other columns. A text without personal data, null and empty texts
    stay as they are; an empty table stays so.
    """
    small_batches(docs.sparkSession)
    out = docs.withColumn("text", redact_udf(threshold)("text"))
    return out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def _digest_batches(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x in batch.column(1):
                spans = find_spans(x.as_py() or "", threshold)
                base = [s for s in spans if s.kind in BASE]
                counts = [sum(s.kind == kind for s in base) for kind in BASE]
                rows.append((*counts, hashlib.sha256(printed(base).encode()).hexdigest(), printed(spans)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            arrays = [pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(c, pa.string()) for c in columns[4:]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    return run


def pii_report(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of docs(doc_id, text): counts of the base kinds, a digest of the base spans, and all spans printed.

    Null counts as the empty text. Repeated rows, null ids and extra columns are harmless.
    """
    small_batches(docs.sparkSession)
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_digest_batches(threshold), schema)


def op9_pii(spark, sf_dir: str) -> DataFrame:
    """Every document's personal data."""
    return pii_report(table(spark, sf_dir, "documents"))
