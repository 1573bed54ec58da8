"""The five read-only questions over a compact schema of written tables: info, search, section, amendments, pending.

Wrong questions fail before anything is read: an odd citation, chapter, page or query is a ValueError, a section that an
edition lacks a LookupError.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.functions import keys
from lexloom.functions.text import excerpt, is_truncated
from lexloom.operators import search

Tables = Callable[[str], DataFrame]

MAX_QUERY = 300
#: Tables whose rows the snapshot's description counts (fixed values).
COUNTED = ("chapters", "sections", "section_versions", "amendments", "pending_changes", "diagnostics")


def section_number(text: str) -> str | None:
    """The section that a text cites, or None where it is no citation."""
    found = re.fullmatch(rf"(?:ORS\s+)?({keys.SECTION})", text.strip().upper())
    return found and found[1]


def _cited(text: str) -> str:
    number = section_number(text)
    if not number:
        raise ValueError(f"no citation: {text!r}")
    return number


def dataset_info(t: Tables) -> DataFrame:
    """(part, name, value) of the snapshot.

    Parts: edition, count, session_year, build (a manifest by its digest only), review (counts by disposition), limit.
    Rows instead of one nested answer, so that no part has to fit into a row.
    """
    spark = t("editions").sparkSession
    row = lambda df, part, name, value: df.select(F.lit(part).alias("part"), F.col(name).cast("string").alias("name"), value.cast("string").alias("value"))
    nothing = F.lit(None).cast("string")
    manifest = F.col("key") == "manifest"
    build = t("build_metadata").select(F.when(manifest, "manifest_sha256").otherwise(F.col("key")).alias("key"), F.when(manifest, F.sha2("value", 256)).otherwise(F.col("value")).alias("value"))
    reviews = t("diagnostic_reviews").groupBy("disposition").agg(F.count("*").alias("n"))
    limits = spark.createDataFrame([("max_page_size", search.MAX_PAGE), ("max_query_length", MAX_QUERY)], "name string, value long")
    out = row(t("editions"), "edition", "edition_year", nothing)
    for name in COUNTED:
        out = out.unionByName(row(t(name).agg(F.count("*").alias("n")).withColumn("name", F.lit(name)), "count", "name", F.col("n")))
    out = out.unionByName(row(t("amendments").select("session_year").distinct(), "session_year", "session_year", nothing))
    out = out.unionByName(row(build, "build", "key", F.col("value"))).unionByName(row(reviews, "review", "disposition", F.col("n")))
    return out.unionByName(row(limits, "limit", "name", F.col("value")))


def search_sections(t: Tables, query: str, edition: int | None = None, chapter: str | None = None, limit: int = 10, offset: int = 0) -> DataFrame:
    """An exact citation's versions, else all-words BM25 within one printed version each.

    Order: rank, newest edition, section, version. One row more than the limit tells of a next page. A citation shows
    the start of the text, other hits the densest passage; only rows of the page are cut into passages.
    """
    search.check_page(limit, offset)
    if not query.strip() or len(query) > MAX_QUERY:
        raise ValueError(f"a query has 1 to {MAX_QUERY} characters")
    if chapter is not None:
        chapter = chapter.strip().upper()
        if not re.fullmatch(r"[1-9]\d{0,2}[A-Z]?", chapter):
            raise ValueError(f"no chapter: {chapter!r}")
    exact = section_number(query)
    if not exact and not search.query_terms(query):
        raise ValueError("a query has a word or a citation")
    rows = t("section_versions").withColumn("chapter_number", F.split_part("ors_section", F.lit("."), F.lit(1)))
    # ranks are those of the whole table, whatever is shown of it
    found = rows.filter(F.col("ors_section") == exact).withColumn("score", F.lit(0.0)) if exact else search.bm25(rows, {"catchline": 5.0, "content_text": 1.0}, query)
    if edition is not None:
        found = found.filter(F.col("edition_year") == edition)
    if chapter is not None:
        found = found.filter(F.col("chapter_number") == chapter)
    joined = found.join(t("chapter_sources").select("edition_year", "chapter_number", "source_url"), ["edition_year", "chapter_number"], "left")
    shown = search.page(joined, ["score", F.col("edition_year").desc(), "ors_section", "version_ordinal"], limit, offset)
    passage = excerpt(F.col("content_text"), 400) if exact else search.snippet(F.col("content_text"), query)
    return shown.select(
        "ors_section", "edition_year", "chapter_number", "version_ordinal", "status", "catchline", passage.alias("excerpt"), F.col("score").alias("rank"), "source_url",
        keys.public_id(F.col("edition_year"), F.col("ors_section"), F.col("version_ordinal")).alias("id"),
    )


def get_section(t: Tables, citation: str, edition: int) -> DataFrame:
    """One row: id, section, versions, notes and sources, the last three as arrays in order."""
    own = (F.col("ors_section") == _cited(citation)) & (F.col("edition_year") == edition)
    section = t("sections").filter(own)
    if not section.head(1):
        raise LookupError(f"{citation} is not in the edition of {edition}")
    key = ["edition_year", "ors_section"]

    def listed(rows: DataFrame, name: str, first: str, by: list[str]) -> DataFrame:
        columns = [first, *[c for c in rows.columns if c != first]]
        return rows.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(name))

    linked = t("chapter_sources").filter(F.col("edition_year") == edition).select("edition_year", "chapter_number", "source_url").join(t("sources"), "source_url")
    out = section.select(*key, "chapter_number", keys.public_id(F.col("edition_year"), F.col("ors_section")).alias("id"), F.struct(*section.columns).alias("section"))
    out = out.join(listed(t("section_versions").filter(own), "versions", "version_ordinal", key), key, "left")
    out = out.join(listed(t("section_notes").filter(own), "notes", "id", key), key, "left")
    out = out.join(listed(linked, "sources", "source_url", ["edition_year", "chapter_number"]), ["edition_year", "chapter_number"], "left")
    some = lambda name: F.coalesce(name, F.array()).alias(name)
    return out.select("id", "section", some("versions"), some("notes"), some("sources"))


def get_amendments(t: Tables, citation: str, session_year: int | None = None, limit: int = 10, offset: int = 0, include_text: bool = False) -> DataFrame:
    """Amendments of a section with their source and context, by session and id.

    Long wordings are cut, and operative texts left out, unless include_text asks for them.
    """
    rows = t("amendments").filter(F.col("affected_ors_section") == _cited(citation))
    if session_year is not None:
        rows = rows.filter(F.col("session_year") == session_year)
    for name in ("amendment_sources", "amendment_context"):
        rows = rows.join(t(name).withColumnRenamed("amendment_id", "id"), "id", "left")
    text = F.col("raw_diff_text")
    if not include_text:
        rows = rows.withColumn("text_truncated", is_truncated(text, 500)).withColumn("raw_diff_text", excerpt(text, 500)).withColumn("operative_text", F.lit(None).cast("string"))
    else:
        rows = rows.withColumn("text_truncated", F.lit(False))
    return search.page(rows, ["session_year", "id"], limit, offset)


def get_pending_changes(t: Tables, citation: str, edition: int | None = None, limit: int = 10, offset: int = 0) -> DataFrame:
    """Pending changes of a section, unknown dates first and never guessed."""
    rows = t("pending_changes").filter(F.col("target_section") == _cited(citation))
    rows = rows.join(t("pending_change_sources").withColumnRenamed("pending_change_id", "id"), "id", "left")
    if edition is not None:
        rows = rows.filter(F.col("edition_year") == edition)
    return search.page(rows, [F.col("effective_date").asc_nulls_first(), "id"], limit, offset)
