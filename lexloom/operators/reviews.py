"""Reviewed expectations against results: reference verification, note sets, reconciliation, manifests, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions.text import collapsed

#: Schema of a parsed act's result that verification reads.
RESULT = (
    "errors array<string>, year int, chapter int, provenance struct<sourceSha256:string,sourceUrl:string>, bill struct<billType:string,billNumber:long>, "
    "affectedSections struct<amended:array<string>,repealed:array<string>>, validation struct<sectionEvidence:array<struct<evidenceSectionNumber:string,evidenceAction:string,"
    "evidenceSource:string,evidenceSectionClause:string,evidenceText:string>>>"
)


def verified_references(references: DataFrame, results: DataFrame, acquisitions: DataFrame) -> DataFrame:
    """references with status: ten outcomes, the first that applies.

    references(section, action A or R, chapter, clause, measure, session_year); results(chapter, result), where result
    has the schema RESULT; acquisitions(chapter, ok, sha256, source_url).
    """
    joined = references.join(results.withColumn("_has", F.lit(True)), "chapter", "left").join(acquisitions, "chapter", "left")
    r, amends = F.col("result"), F.col("action") == "A"
    evidence = F.filter(r["validation"]["sectionEvidence"], lambda e: e["evidenceSectionNumber"] == F.col("section"))
    operative = F.filter(evidence, lambda e: (e["evidenceSource"] == "OperativeBodyEvidence") & (e["evidenceSectionClause"] == F.col("clause")))
    wanted = F.when(amends, "AmendmentAction").otherwise("RepealAction")
    changed = lambda mine: F.when(amends == F.lit(mine), r["affectedSections"]["amended"]).otherwise(r["affectedSections"]["repealed"])
    pinned = F.col("ok") & F.col("sha256").rlike("^[0-9a-f]{64}$") & (F.col("source_url") != "") & (r["provenance"]["sourceSha256"] == F.col("sha256")) & (r["provenance"]["sourceUrl"] == F.col("source_url"))
    measure = F.concat_ws(" ", r["bill"]["billType"], r["bill"]["billNumber"].cast("string"))
    holds = lambda c: F.coalesce(c, F.lit(False))
    parts = F.col("_ops").isNotNull() & r["affectedSections"]["amended"].isNotNull() & r["affectedSections"]["repealed"].isNotNull()
    status = (
        F.when(F.col("_has").isNull(), "missing-result")
        .when(r.isNull(), "invalid-result")
        .when(holds(F.size(r["errors"]) > 0), "parser-error")
        .when(~holds((r["year"] == F.col("session_year")) & (r["chapter"] == F.col("chapter"))), "identity-mismatch")
        .when(~holds(pinned), "provenance-mismatch")
        .when(~holds(measure == F.col("measure")), "measure-mismatch")
        .when(~parts, "invalid-result")
        .when(F.exists("_ops", lambda e: e["evidenceAction"] != wanted), "conflicting-action")
        .when(F.array_contains(changed(True), F.col("section")), F.when(F.size("_ops") == 0, "missing-operative-evidence").when(F.exists("_ops", lambda e: F.coalesce(F.trim(e["evidenceText"]), F.lit("")) == ""), "invalid-result").otherwise("exact-match"))
        .when(F.array_contains(changed(False), F.col("section")), "conflicting-action")
        .otherwise("missing-affected-section")
    )
    return joined.withColumn("_ops", operative).withColumn("status", status).select(*references.columns, "status")


def verification_gate(verified: DataFrame) -> DataFrame:
    """One row: counts and whether there are references and all match."""
    exact = F.col("status") == "exact-match"
    return verified.agg(F.count("*").alias("n"), F.count_if(exact).alias("n_exact"), (F.coalesce(F.bool_and(exact), F.lit(False))).alias("passed"))


def reconciled_notices(pending: DataFrame, results: DataFrame) -> DataFrame:
    """pending(session_year, session_law_chapter, ...) with one of four states by results(..., status)."""
    joined = pending.join(results.select("session_year", "session_law_chapter", F.col("status").alias("result_status")), ["session_year", "session_law_chapter"], "left")
    state = (
        F.when(F.col("session_law_chapter").isNull(), "non-specific-notice")
        .when(F.col("result_status").isNull(), "missing-session-result")
        .when(F.col("result_status") == "parsed", "matched-parsed")
        .otherwise("matched-parser-error")
    )
    return joined.withColumn("reconciliation_status", state)


def reconciliation_counts(reconciled: DataFrame) -> DataFrame:
    """One row of counts per state, and whether everything specific is resolved."""
    n = lambda s: F.count_if(F.col("reconciliation_status") == s)
    errors, missing = n("matched-parser-error"), n("missing-session-result")
    return reconciled.agg(F.count("*").alias("n"), n("non-specific-notice").alias("non_specific"), n("matched-parsed").alias("matched"), errors.alias("errors"), missing.alias("missing"), ((errors == 0) & (missing == 0)).alias("all_resolved"))


def compared_notes(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(section_id, ordinal, state) of two note sets: matched, mismatched, missing, extra.

    Both have note_kind and note_text; the actual text counts with its white space collapsed.
    """
    e = expected.select("section_id", "ordinal", F.struct("note_kind", "note_text").alias("e"))
    a = actual.select("section_id", "ordinal", F.struct("note_kind", collapsed(F.col("note_text")).alias("note_text")).alias("a"))
    both = e.join(a, ["section_id", "ordinal"], "full_outer")
    state = F.when(F.col("a").isNull(), "missing").when(F.col("e").isNull(), "extra").when(F.col("e") == F.col("a"), "matched").otherwise("mismatched")
    return both.select("section_id", "ordinal", state.alias("state"))


def note_problems(notes: DataFrame) -> DataFrame:
    """(section_id, ordinal, problem): ordinals that aren't 1, 2, ..., blank texts, offsets that don't fit."""
    dup = notes.groupBy("section_id", "ordinal").agg(F.count("*").alias("n")).filter("n > 1").select("section_id", "ordinal", F.lit("duplicate").alias("problem"))
    gaps = notes.groupBy("section_id").agg(F.max("ordinal").alias("ordinal"), F.count_distinct("ordinal").alias("k"), F.min("ordinal").alias("low")).filter("ordinal <> k or low <> 1").select("section_id", "ordinal", F.lit("ordinals").alias("problem"))
    blank = notes.filter("trim(note_text) = ''").select("section_id", "ordinal", F.lit("blank").alias("problem"))
    span = notes.filter("start < 0 or end - start <> length(note_text)").select("section_id", "ordinal", F.lit("offsets").alias("problem"))
    return dup.union(gaps).union(blank).union(span)


def pairs(results: DataFrame, amended: Column, repealed: Column, keep: list[str]) -> DataFrame:
    """keep, action, section: distinct pairs of two arrays of changed sections."""
    each = lambda c, action: results.select(*keep, F.lit(action).alias("action"), F.explode(c).alias("section"))
    return each(amended, "amended").unionByName(each(repealed, "repealed")).distinct()


def conflicts(expected: DataFrame, actual: DataFrame, keep: list[str]) -> DataFrame:
    """keep, false_positives, false_negatives as ascending arrays, for what needs review only."""
    both = expected.withColumn("e", F.lit(1)).join(actual.withColumn("a", F.lit(1)), [*keep, "action", "section"], "full_outer")
    item = F.concat_ws(" ", "action", "section")
    pick = lambda bad: F.array_sort(F.collect_set(F.when(bad, item)))
    out = both.groupBy(*keep).agg(pick(F.col("e").isNull()).alias("false_positives"), pick(F.col("a").isNull()).alias("false_negatives"))
    return out.filter((F.size("false_positives") > 0) | (F.size("false_negatives") > 0))


def coverage_gaps(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side) of ids that only one of two sets has."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("right")))


def expanded_tags(tagged: DataFrame, tags: str, aliases: dict[str, list[str]]) -> DataFrame:
    """tagged with aliases' tags added to each array, ascending and distinct."""
    known = F.create_map(*[x for k, v in aliases.items() for x in (F.lit(k), F.array(*[F.lit(t) for t in v]))])
    more = F.flatten(F.transform(tags, lambda t: F.coalesce(F.try_element_at(known, t), F.array().cast("array<string>"))))
    return tagged.withColumn(tags, F.array_sort(F.array_distinct(F.concat(F.col(tags), more))))


def provenance_problems(rows: DataFrame) -> DataFrame:
    """rows(expected_sha256, sha256, expected_url, url, status) with problems, an array in a fixed order."""
    rules = [
        ("not-acquired", F.col("status").isNull() | (F.col("status") != "ok")),
        ("sha256-format", ~F.coalesce(F.col("sha256").rlike("^[0-9a-f]{64}$"), F.lit(False))),
        ("sha256-differs", ~F.col("sha256").eqNullSafe(F.col("expected_sha256"))),
        ("url-differs", ~F.col("url").eqNullSafe(F.col("expected_url"))),
    ]
    return rows.withColumn("problems", F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules])))
