"""Act summaries: bill, year, chapter, date and the sections that title and body say are changed, with evidence.

All native: fields are ordered coalesces of first matches, evidence is arrays of structs, and what is missing
accumulates as an array of error codes instead of stopping at the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions.text import first_match

NUMBER = "[0-9]{1,3}[A-Z]?\\.[0-9]{3,4}"
#: Wordings of acts (fixed values).
_BILL = "(HB|SB) [0-9]+|Ballot Measure (No\\. )?[0-9]+"
_DATE = "[A-Za-z]+\\s+[0-9]{1,2},\\s+[0-9]{4}"
#: The words that make a clause operative, and what they do (fixed values).
MARKERS = ((" is amended to read", "amend"), (" are amended to read", "amend"), (" is repealed", "repeal"), (" are repealed", "repeal"))
_SEPARATOR = "\\s*(,\\s*|\\s+and\\s+)(ORS\\s+)?"
_TARGETS = f"ORS\\s+{NUMBER}({_SEPARATOR}{NUMBER})*"
_TAIL = "(\\s+and\\s+sections?\\s+[0-9A-Za-z]+(\\s*,\\s*[0-9A-Za-z]+)*(\\s+and\\s+[0-9A-Za-z]+)?,\\s+chapter\\s+[0-9]+,\\s+Oregon Laws\\s+[0-9]{4}(\\s*\\([^)]*\\))?)?"
_DIRECT = f"(If\\s+[^,]+\\s+becomes\\s+law,\\s*)?{_TARGETS}{_TAIL}(\\s*,\\s*as amended by .*)?\\s*,?\\s*$"
_CLAUSE_START = "^[0-9]+[A-Za-z]?\\.\\s*(Repeals\\.\\s*)?(\\([0-9]+\\)\\s*)?"
_EVIDENCE = "array<struct<section:string,action:string,source:string,clause:string,excerpt:string>>"


def bill(text: Column) -> Column:
    """Struct kind (HB, SB, BallotMeasure) and number, or null (H1)."""
    found = first_match(text, _BILL)
    kind = F.when(found.startswith("HB"), "HB").when(found.startswith("SB"), "SB").otherwise("BallotMeasure")
    return F.when(found.isNotNull(), F.struct(kind.alias("kind"), F.regexp_extract(found, "([0-9]+)$", 1).cast("long").alias("number")))


def year_candidates(text: Column) -> Column:
    """Distinct years of headings, then of 'this 2023 Act' (H2)."""
    heads = F.regexp_extract_all(text, F.lit("(?:OREGON LAWS|Oregon Laws) ([0-9]{4})"), F.lit(1))
    acts = F.regexp_extract_all(text, F.lit("(?:This|this) ([0-9]{4}) Act"), F.lit(1))
    return F.array_distinct(F.transform(F.concat(heads, acts), lambda y: y.cast("int")))


def source_year(location: Column) -> Column:
    """The year that a source's address names (H3)."""
    return F.regexp_extract(F.regexp_extract(location, "[0-9]{4}(?:[Ss][0-9]+)?[Oo][Rr][Ll]aw|[0-9]{4}adv", 0), "^[0-9]{4}", 0).try_cast("int")


def year(text: Column, location: Column) -> Column:
    """The source's year if the text has it or has none, else the text's greatest (H2, H3)."""
    years, own = year_candidates(text), source_year(location)
    return F.when(own.isNotNull() & ((F.size(years) == 0) | F.array_contains(years, own)), own).otherwise(F.array_max(years))


def chapter(text: Column, location: Column) -> Column:
    """The chapter that the text names, else its source's address (H4)."""
    printed = F.regexp_extract(text, "(?:Chap\\.|Chapter) ([0-9]{1,4})", 1).try_cast("int")
    return F.coalesce(printed, F.regexp_extract(location, "(?:[Oo][Rr][Ll]aw|adv)([0-9]{4})", 1).try_cast("int"))


def named_date(text: Column) -> Column:
    return F.try_to_timestamp(F.regexp_replace(F.regexp_extract(text, _DATE, 0), "\\s+", " "), F.lit("MMMM d, yyyy")).cast("date")


def _date_after(text: Column, marker: str) -> Column:
    rest = F.get(F.split(text, marker.replace(".", "\\."), -1), F.lit(1))
    return F.when(F.contains(text, F.lit(marker)), named_date(rest))


def effective_date(text: Column, location: Column | None = None) -> Column:
    """Stated date, the Act's own, thirty days after an election, a proclamation's, or the default (H5, H6)."""
    referred = F.contains(text, F.lit("referred to the people")) | F.contains(text, F.lit("submitted to the people"))
    proclaimed = F.contains(text, F.lit("Ballot Measure ")) & F.contains(text, F.lit("full force and effect"))
    found = F.coalesce(
        named_date(first_match(text, f"Effective\\s+date\\s+{_DATE}")),
        _date_after(text, "Act takes effect"),
        F.when(referred, F.date_add(_date_after(text, "election"), 30)),
        F.when(proclaimed, _date_after(text, "Governor dated")),
    )
    if location is None:
        return found
    own = source_year(location)
    return F.coalesce(found, F.when(bill(text)["kind"].isin("HB", "SB") & (own >= 1999), F.make_date(own + 1, F.lit(1), F.lit(1))))


def summary(paragraphs: Column) -> Column:
    """The one 'Relating to' sentence, or null where there is none or more than one (H7)."""
    first = F.transform(paragraphs, lambda p: F.trim(F.regexp_replace(F.get(F.split(p, "\\. "), F.lit(0)), "\\s+", " ")))
    own = F.filter(first, lambda p: p.startswith("Relating to"))
    closed = F.get(own, F.lit(0))
    return F.when(F.size(own) == 1, F.when(closed.endswith("."), closed).otherwise(F.concat(closed, F.lit("."))))


def _numbers(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(NUMBER), F.lit(0))


def _evidence(sections: Column, action: Column, source: str, clause: Column, excerpt: Column) -> Column:
    return F.transform(sections, lambda n: F.struct(n.alias("section"), action.alias("action"), F.lit(source).alias("source"), clause.alias("clause"), excerpt.alias("excerpt")))


def title_evidence(title: Column) -> Column:
    """Sections by the title's amending and repealing clauses (H8)."""
    none = F.array().cast(_EVIDENCE)

    def of(action: str, word: str) -> Column:
        parts = F.filter(F.split(title, "; "), lambda c: F.contains(c, F.lit(word)))
        return F.flatten(F.transform(parts, lambda c: _evidence(F.array_sort(F.array_distinct(_numbers(c))), F.lit(action), "title", F.lit(None).cast("string"), c)))

    return F.coalesce(F.concat(of("amend", "amending"), of("repeal", "repealing")), none)


def _operative(block: Column, start: str, clause: Column) -> Column:
    """Evidence of a block whose text before its earliest operative words names nothing but direct targets."""
    none = F.array().cast(_EVIDENCE)
    at = [F.when(F.contains(block, F.lit(m)), F.instr(block, m)) for m, _ in MARKERS]
    first = F.array_min(F.array(*at))
    action, marker = F.lit(None).cast("string"), F.lit("")
    for (words, kind), place in zip(MARKERS, at, strict=True):
        hit = place == first
        action, marker = F.when(hit, kind).otherwise(action), F.when(hit, words).otherwise(marker)
    before = F.substring(block, F.lit(1), first - 1)
    direct = first.isNotNull() & before.rlike(f"(?s){start}{_DIRECT}")
    return F.when(direct, _evidence(_numbers(before), action, "body", clause, F.concat(before, marker))).otherwise(none)


def _behind(parts: Column) -> Column:
    """All parts but the first."""
    return F.slice(parts, 2, F.size(parts))


def body_evidence(text: Column) -> Column:
    """Sections that operative clauses and their numbered parts act on directly (H9)."""

    def of(block: Column) -> Column:
        clause = F.nullif(F.regexp_extract(block, "^[0-9]+[A-Za-z]?", 0), F.lit(""))
        parts = _behind(F.split(block, "\\) ORS "))
        inner = F.flatten(F.transform(parts, lambda p: _operative(F.concat(F.lit("ORS "), p), "^", clause)))
        return F.array_distinct(F.concat(_operative(block, _CLAUSE_START, clause), inner))

    return F.flatten(F.transform(_behind(F.split(text, "SECTION ")), of))


def change_set(evidence: Column) -> Column:
    """Struct amended and repealed: ascending distinct sections."""
    of = lambda a: F.array_sort(F.array_distinct(F.transform(F.filter(evidence, lambda e: e["action"] == a), lambda e: e["section"])))
    return F.struct(of("amend").alias("amended"), of("repeal").alias("repealed"))


def _is_empty(changes: Column) -> Column:
    return (F.size(changes["amended"]) == 0) & (F.size(changes["repealed"]) == 0)


def validation_status(title: Column, body: Column) -> Column:
    """Incomplete, Verified, ParsedUnverified or Conflict of two change sets."""
    return F.when(_is_empty(title) & _is_empty(body), "Incomplete").when(title == body, "Verified").when(_is_empty(body), "ParsedUnverified").otherwise("Conflict")


def best_change_set(title: Column, body: Column) -> Column:
    """The body's change set unless it is empty."""
    return F.when(_is_empty(body), title).otherwise(body)


def read_acts(acts: DataFrame) -> DataFrame:
    """acts(doc_id, paragraphs, location) -> fields, evidence, change sets, status and accumulated errors."""
    staged = acts.select("doc_id", "paragraphs", "location", F.array_join("paragraphs", " ").alias("text"))
    t, where = F.col("text"), F.col("location")
    staged = staged.select("*", bill(t).alias("bill"), year(t, where).alias("year"), chapter(t, where).alias("chapter"), effective_date(t, where).alias("effective_date"), summary(F.col("paragraphs")).alias("summary"))
    staged = staged.withColumn("title_evidence", title_evidence(F.col("summary"))).withColumn("body_evidence", body_evidence(t))
    staged = staged.withColumn("title_changes", change_set(F.col("title_evidence"))).withColumn("body_changes", change_set(F.col("body_evidence")))
    codes = (("bill", "MissingCitation"), ("year", "MissingYear"), ("chapter", "MissingChapter"), ("effective_date", "MissingEffectiveDate"))
    errors = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(code)) for c, code in codes]))
    return staged.withColumn("errors", errors).select(
        "doc_id", "bill", "year", "chapter", "effective_date", "summary",
        best_change_set(F.col("title_changes"), F.col("body_changes")).alias("changes"),
        validation_status(F.col("title_changes"), F.col("body_changes")).alias("status"),
        F.concat("title_evidence", "body_evidence").alias("evidence"), "errors",
    )


def counsel_changes(rows: DataFrame) -> DataFrame:
    """Counsel rows(section, action, chapter, year) -> change set per year and chapter; additions are none."""
    of = lambda a: F.array_sort(F.collect_set(F.when(F.col("action") == a, F.col("section"))))
    return rows.groupBy("year", "chapter").agg(F.struct(of("amended").alias("amended"), of("repealed").alias("repealed")).alias("counsel"))


def reconciled(acts: DataFrame, rows: DataFrame) -> DataFrame:
    """acts with counsel_status: no-rows, agrees or differs."""
    joined = acts.join(counsel_changes(rows), ["year", "chapter"], "left")
    return joined.withColumn("counsel_status", F.when(F.col("counsel").isNull(), "no-rows").when(F.col("counsel") == F.col("changes"), "agrees").otherwise("differs"))
