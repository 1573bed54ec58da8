"""Chapters to sections: anchors from bold runs, spans by the next anchor, bodies, credits, stubs, subdivisions.

The scan of one document (which bold runs are anchors) is a function over styled text; everything after it, ordinals,
versions, owners, statuses, is windows and expressions per document.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.functions.styled import STYLED
from lexloom.operators import statutes

_ANCHOR = re.compile(r"(\d{1,3}[A-Z]?\.\d{3,4})\s*(.*)", re.S)
_CREDIT = "\\[[^\\[\\]]*(?:18|19|20)\\d{2}[^\\[\\]]*\\]|\\[(?i:Formerly|Renumbered)[^\\[\\]]*\\]"
_SECTION = T.StructType([T.StructField("number", T.StringType()), T.StructField("catchline", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("body_start", T.IntegerType()), T.StructField("end", T.IntegerType())])
_SECTION_ARROW = pa.list_(pa.struct([("number", pa.string()), ("catchline", pa.string()), ("start", pa.int32()), ("body_start", pa.int32()), ("end", pa.int32())]))


def anchors(text: str, runs: list[tuple[int, int, bool, bool]]) -> list[tuple[str, str, int, int, int]]:
    """(number, catchline, start, body start, end) of the sections that bold runs at a line's start open, in order.

    A catchline that wraps is one anchor: bold runs parted by nothing but white space count as one.
    """
    bold: list[list[int]] = []
    for start, end, is_bold, _ in runs:
        if is_bold:
            if bold and not text[bold[-1][1] : start].strip() and "\n" not in text[bold[-1][1] : start]:
                bold[-1][1] = end
            else:
                bold.append([start, end])
    found = []
    for start, end in bold:
        start += len(text[start:end]) - len(text[start:end].lstrip())
        m = _ANCHOR.match(text[start:end])
        if m and not text[text.rfind("\n", 0, start) + 1 : start].strip():
            found.append((m[1], " ".join(m[2].split()), start, end))
    ends = [f[2] for f in found[1:]] + [len(text)]
    return [(*f, e) for f, e in zip(found, ends, strict=True)]


@F.arrow_udf(T.ArrayType(_SECTION))
def anchors_udf(styled: pa.Array) -> pa.Array:
    """struct text, runs -> array of struct number, catchline, start, body_start, end."""

    def one(value):
        runs = [(r["start"], r["end"], r["bold"], r["underline"]) for r in (value or {}).get("runs") or []]
        return [dict(zip(_SECTION.names, a, strict=True)) for a in anchors((value or {}).get("text") or "", runs)]

    return pa.array((one(x.as_py()) for x in styled), _SECTION_ARROW)


def sections(chapters: DataFrame, keys: list[str], styled: str = "styled") -> DataFrame:
    """keys, number, version_ordinal, catchline, body_text, source_credit, status, start, end.

    The last dated bracket of a section is its credit and leaves its body; a section without body is a stub whose
    status its credit tells.
    """
    if chapters.schema[styled].dataType.names != STYLED.names:
        raise ValueError(f"{styled} must be a struct of text and runs")
    each = chapters.select(*keys, F.col(f"{styled}.text").alias("_t"), F.posexplode(anchors_udf(F.col(styled))).alias("position", "s"))
    raw = F.substring(F.col("_t"), F.col("s.body_start") + 1, F.col("s.end") - F.col("s.body_start"))
    each = each.select(*keys, "position", "s.number", "s.catchline", "s.start", "s.end", raw.alias("raw"))
    found = F.regexp_extract_all("raw", F.lit(_CREDIT), F.lit(0))
    each = each.withColumn("source_credit", F.when(F.size(found) > 0, F.element_at(found, -1)))
    # the last place of the credit: the first in the reversed text
    tail = F.expr("locate(reverse(source_credit), reverse(raw)) - 1")
    each = each.withColumn("_after", F.when(F.col("source_credit").isNotNull(), tail).otherwise(0))
    head = F.substring("raw", F.lit(1), F.length("raw") - F.col("_after") - F.coalesce(F.length("source_credit"), F.lit(0)))
    cut = F.concat_ws(" ", head, F.when(F.col("_after") > 0, F.expr("right(raw, _after)")))
    each = each.withColumn("body_text", F.nullif(F.trim(F.regexp_replace(cut, "(?U)\\s+", " ")), F.lit("")))
    stub = statutes.stub_kind(F.coalesce("source_credit", F.lit("")))
    each = each.withColumn("_stub", stub).withColumn("status", F.when(F.col("body_text").isNull(), F.col("_stub.status")).otherwise("active"))
    each = each.withColumn("renumbered_to", F.when(F.col("status") == "renumbered", F.col("_stub.renumbered_to")))
    versions = Window.partitionBy(*keys, "number").orderBy("position")
    return each.withColumn("version_ordinal", F.row_number().over(versions) - 1).select(
        *keys, "position", "number", "version_ordinal", "catchline", "body_text", "source_credit", "status", "renumbered_to", "start", "end"
    )


def integrity(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(rule, row_key) of sections that can't be right: empty active bodies, spans out of order, foreign numbers."""
    key = F.concat_ws(":", *keys, "number", "version_ordinal")
    after = F.lead("start").over(Window.partitionBy(*keys).orderBy("position"))
    checked = rows.withColumn("_after", after)
    rules = [
        ("empty-active", (F.col("status") == "active") & F.col("body_text").isNull()),
        ("span", (F.col("start") >= F.col("end")) | (F.col("_after") < F.col("end"))),
        ("status", ~F.col("status").isin("active", "repealed", "renumbered", "reserved", "note_only")),
    ]
    out = checked.select(F.explode(F.array_compact(F.array(*[F.when(bad, F.lit(rule)) for rule, bad in rules]))).alias("rule"), key.alias("row_key"))
    return out
