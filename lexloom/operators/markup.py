"""Operators over raw markup that need no parser state: titles, charsets, links, tags, structure counts."""

from __future__ import annotations

from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TITLE = "(?is)<title[^>]*>(.*?)</title\\s*>"
CHARSET = "(?i)charset\\s*=\\s*[\"']?([A-Za-z0-9_.:-]+)"
HREF = "(?i)href\\s*=\\s*[\"']([^\"']+)[\"']"
TAG = "<\\s*([A-Za-z][A-Za-z0-9]*)"
BOLD = "(?is)<b\\b[^>]*>(.*?)</b\\s*>"
SECTION = "\\d{1,3}[A-Z]?\\.\\d{3,4}"
#: Named references that SQL replaces; anything else needs html_text() of lexloom.functions.styled (fixed values).
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def unescaped(text: Column) -> Column:
    """The common character references replaced."""
    for name, char in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def page_title(html: Column) -> Column:
    """White-space-collapsed title, or null."""
    return F.when(html.rlike(TITLE), F.trim(F.regexp_replace(F.regexp_extract(html, TITLE, 1), "\\s+", " ")))


def declared_charset(html: Column) -> Column:
    """Charset named in the first 8 KiB, lower case, or null."""
    head = F.substring(html, 1, 8192)
    return F.when(head.rlike(CHARSET), F.lower(F.regexp_extract(head, CHARSET, 1)))


def bold_texts(html: Column) -> Column:
    """Array of white-space-collapsed bold texts without inner tags."""
    return F.transform(F.regexp_extract_all(html, F.lit(BOLD), F.lit(1)), lambda b: F.trim(F.regexp_replace(F.regexp_replace(b, "<[^>]+>", ""), "\\s+", " ")))


def visible_lines(html: Column) -> Column:
    """Array of the text lines a reader would see."""
    text = F.regexp_replace(html, "(?is)<(script|style)\\b.*?</\\1\\s*>", "")
    text = F.regexp_replace(F.regexp_replace(text, "(?i)<\\s*(br|/p|/div|/li|/tr|/h[1-6])\\b[^>]*>", "\n"), "(?s)<[^>]+>", "")
    return F.filter(F.transform(F.split(unescaped(text), "\n"), lambda line: F.trim(F.regexp_replace(line, "\\s+", " "))), lambda line: line != "")


def links(pages: DataFrame, html: str = "html") -> DataFrame:
    """Distinct href values, character references replaced."""
    raw = pages.select(F.explode(F.regexp_extract_all(html, F.lit(HREF), F.lit(1))).alias("raw"))
    return raw.select(unescaped(F.col("raw")).alias("href")).distinct()


def tag_counts(pages: DataFrame, html: str = "html") -> DataFrame:
    """tag, n over all pages."""
    tags = pages.select(F.explode(F.regexp_extract_all(html, F.lit(TAG), F.lit(1))).alias("tag"))
    return tags.select(F.lower("tag").alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


def structure(html: Column) -> dict[str, Column]:
    """Counts that tell how regular a page's markup is."""
    count = lambda p: F.regexp_count(html, F.lit(p)).cast("long")
    return {
        "n_bold_open": count("(?i)<b\\b"),
        "n_bold_close": count("(?i)</b\\s*>"),
        "n_paragraphs": count("(?i)<p\\b"),
        "n_scripts": count("(?i)<script\\b"),
        "n_links": count("(?i)href\\s*="),
    }


def structural_defect(html: Column) -> Column:
    """The first defect that a page has, or null."""
    s = structure(html)
    return (
        F.when(F.length(F.trim(html)) == 0, "empty")
        .when(s["n_paragraphs"] == 0, "no-paragraphs")
        .when(s["n_bold_open"] == 0, "no-bold-runs")
        .when(s["n_bold_close"] < s["n_bold_open"], "unclosed-bold")
    )


def source_format(name: Column, head: Column) -> Column:
    """pdf, html or null by magic bytes, then markup, then the name's extension."""
    start = F.lower(F.ltrim(F.substring(head, 1, 512)))
    return (
        F.when(F.substring(head, 1, 5) == "%PDF-", "pdf")
        .when(start.startswith("<!doctype html") | start.startswith("<html") | F.contains(start, F.lit("<html")), "html")
        .when(F.lower(name).endswith(".pdf"), "pdf")
        .when(F.lower(name).rlike("\\.html?$"), "html")
    )


def strict_format(head: Column) -> Column:
    """pdf, html or null by content alone."""
    return source_format(F.lit(""), head)


@F.arrow_udf(T.StringType())
def _joined(base: pa.Array, href: pa.Array) -> pa.Array:
    pairs = ((b.as_py(), h.as_py()) for b, h in zip(base, href, strict=True))
    return pa.array((None if b is None or h is None else urljoin(b, h) for b, h in pairs), pa.string())


def resolved_links(pages: DataFrame, base: str, html: str = "html") -> DataFrame:
    """base, url: distinct link targets of each page resolved against its address, ascending."""
    raw = pages.select(F.col(base).alias("base"), F.explode(F.regexp_extract_all(html, F.lit(HREF), F.lit(1))).alias("raw"))
    return raw.select("base", _joined("base", unescaped(F.col("raw"))).alias("url")).distinct().orderBy("base", "url")
