"""Queries of the text grammar over small inline fixtures; the SQL states the rows that they must give."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions import acts, credits, styled
from lexloom.operators import history, legacy, segment, statutes, terms

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(columns: str, rows: list[tuple]):
    """Registers a function (spark) -> DataFrame with the rows it must give."""

    def literal(v) -> str:
        if v is None:
            return "NULL"
        return f"$${v}$$" if isinstance(v, str) else str(v)

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(spark)

        run.__doc__, run.__name__ = function.__doc__, function.__name__
        QUERIES[function.__name__] = run
        values = ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows)
        kinds = [c.split() for c in columns.split(", ")]
        ORACLES[function.__name__] = "SELECT " + ", ".join(f"{n}::{k} AS {n}" for n, k in kinds) + f" FROM (VALUES {values}) AS v({', '.join(n for n, _ in kinds)})"
        return function

    return register


_CREDITS = [
    (1, "[1971 c.743 §3; 2025 c.161 §§4,4a]"),
    (2, "[Amended by 1961 c.160 §4; repealed by 1973 c.794 §34]"),
    (3, "[repealed by 1979 c.43 §1 and by 1979 c.190 §431]"),
    (4, "[1981 s.s. c.1 §3; Formerly 646.185]"),
]


@query(
    "id INTEGER, action VARCHAR, session_year INTEGER, special_session INTEGER, session_law_chapter INTEGER, session_law_section VARCHAR",
    [
        (1, "unspecified", 1971, None, 743, "3"), (1, "unspecified", 2025, None, 161, "4"), (1, "unspecified", 2025, None, 161, "4a"),
        (2, "amended", 1961, None, 160, "4"), (2, "repealed", 1973, None, 794, "34"),
        (3, "repealed", 1979, None, 43, "1"), (3, "repealed", 1979, None, 190, "431"), (4, "unspecified", 1981, 1, 1, "3"),
    ],
)
def credit_rows(spark):
    """Source credits to citations."""
    frame = spark.createDataFrame(_CREDITS, "id int, raw string").select("id", F.explode(credits.credit_udf("raw")["citations"]).alias("c"))
    return frame.select("id", "c.action", "c.session_year", "c.special_session", "c.session_law_chapter", "c.session_law_section")


@query("id INTEGER, kind VARCHAR, number VARCHAR", [(2, "renumbered", "161.045"), (2, "renumbered", "192.411"), (1, "formerly", "646.185"), (3, "in_lieu", "1.050"), (3, "unparsed", "odd one")])
def credit_references(spark):
    """Sections and leftovers that credits name."""
    raw = [(1, "[Formerly 646.185]"), (2, "[Renumbered 161.045; subsections (1) to (3) renumbered 192.411 in 2017]"), (3, "[enacted in lieu of 1.050; odd one]")]
    parsed = spark.createDataFrame(raw, "id int, raw string").select("id", credits.credit_udf("raw").alias("c"))
    each = [parsed.select("id", F.lit(k).alias("kind"), F.explode(f"c.{k}").alias("number")) for k in ("formerly", "renumbered", "in_lieu", "unparsed")]
    return each[0].unionByName(each[1]).unionByName(each[2]).unionByName(each[3])


@query("ordinal INTEGER, operation VARCHAR, token VARCHAR", [(0, "KEEP", "The"), (1, "MARKER", "["), (2, "DELETE", "old"), (3, "MARKER", "]"), (4, "ADD", "new"), (5, "KEEP", "pre"), (6, "ADD", "mid"), (7, "KEEP", "."), (8, "KEEP", "cooperate")])
def edit_tokens(spark):
    """Markup to edit tokens, split where a style changes within a word."""
    frame = spark.createDataFrame([("<p>The [<i>old</i>] <b>new</b> pre<u>mid</u>. co-<br>operate</p>",)], "html string")
    tokens = frame.select(F.posexplode(styled.tokens_udf(styled.html_styled("html"))["tokens"]).alias("ordinal", "t"))
    return tokens.select("ordinal", "t.operation", F.col("t.text").alias("token"))


_ACT = (
    "<p>OREGON LAWS 2023 Chap. 12</p><p>AN ACT HB 2001</p><p>SECTION 1. ORS 161.005 is amended to read:</p><p>161.005. The [old] <b>new</b> text.</p>"
    "<p>SECTION 2. ORS 161.015 and 161.025 are repealed.</p><p>SECTION 3. Section 4 of this 2023 Act is added to and made a part of chapter 161.</p>"
    "<p>SECTION 4. A fresh duty.</p><p>SECTION 5. If House Bill 7 becomes law, ORS 161.035 is repealed.</p><p>SECTION 6. ORS 1.010 to 1.050 are repealed.</p>"
)


@query(
    "kind VARCHAR, clause VARCHAR, action_type VARCHAR, affected_section VARCHAR, n_tokens INTEGER, note VARCHAR",
    [
        ("action", "1", "AMEND", "161.005", 11, None), ("action", "2", "REPEAL", "161.015", 0, None), ("action", "2", "REPEAL", "161.025", 0, None),
        ("action", "4", "ADD", None, 4, None), ("action", "5", "REPEAL", "161.035", 0, "If House Bill 7 becomes law"),
        ("diagnostic", "6", None, None, None, "repeal range requires an edition roster"), ("error", None, None, None, None, "no single session-law year in the masthead"),
    ],
)
def session_actions(spark):
    """Session acts to actions, diagnostics and errors."""
    rows = acts.session_rows(spark.createDataFrame([("a", _ACT), ("b", "<p>none</p>")], "doc_id string, markup string"))
    note = F.coalesce("condition_text", "reason", "error").alias("note")
    return rows.select("kind", F.col("session_law_section").alias("clause"), "action_type", "affected_section", F.when(F.col("kind") == "action", F.size("tokens")).alias("n_tokens"), note)


@query("change_kind VARCHAR, session_year INTEGER, session_law_chapter INTEGER", [("new_compiled_section", 2026, 11), ("new_compiled_section", 2026, 17), ("amended_or_repealed_elsewhere", 2026, None)])
def notices(spark):
    """Pending-change notices, a row per chapter named."""
    compiled = "New sections of law were enacted by the Legislative Assembly during its 2026 regular session and pertain to or are likely to be compiled in this ORS chapter. See sections in the following 2026 Oregon Laws chapters: 2026 Session Laws 0011; 0017"
    table = "ORS sections in this chapter were amended or repealed by the Legislative Assembly during its 2026 regular session. See the table of ORS sections amended or repealed during the 2026 regular session: 2026 A&R Tables"
    return statutes.notices(spark.createDataFrame([(compiled,), (table,), ("other",)], "line string")).select("change_kind", "session_year", "session_law_chapter")


@query("citation VARCHAR, defined_term VARCHAR, definition_text VARCHAR", [("1.1", "Attorney fees", "fees."), ("1.1", "Animal", "includes pets."), ("1.1", "Holder", "a holder."), ("1.1", "keeper", "a holder.")])
def definitions(spark):
    """Definitions with aliases and verbs."""
    text = 'Definitions\n(1) "Attorney fees" means fees.\n(2)(a) "Animal" includes pets.\n(3) "Holder" or "keeper" means a holder.'
    return statutes.definitions(spark.createDataFrame([("1.1", text), ("1.2", "plain")], "c string, t string"), "t", "c")


@query("kind VARCHAR, shown VARCHAR, start_at INTEGER, number VARCHAR, section_id VARCHAR", [("range", "1.194 to 1.200", 4, "1.194", None), ("range", "1.194 to 1.200", 4, "1.200", "s1"), ("section", "90.100", 27, "90.100", None), ("chapter", "chapter 279A", 42, None, None)])
def cross_references(spark):
    """References with offsets, resolved where the section is known."""
    refs = statutes.references(spark.createDataFrame([(1, "ORS 1.194 to 1.200; see ORS90.100 and ORS chapter 279A.")], "id int, body string"), "body", ["id"])
    known = spark.createDataFrame([("1.200", "s1")], "number string, section_id string")
    return statutes.resolved(refs, known).select("kind", F.col("text").alias("shown"), F.col("start").alias("start_at"), "number", "section_id")


@query("id INTEGER, ordinal INTEGER, note_text VARCHAR, start_at INTEGER, end_at INTEGER", [(1, 1, "Note: first.", 6, 18), (1, 2, "Notes: second", 19, 32)])
def editorial_notes(spark):
    """Note blocks with offsets."""
    notes = statutes.note_blocks(spark.createDataFrame([(1, "Body. Note: first. Notes: second "), (2, "x")], "id int, body string"), "body", ["id"])
    return notes.select("id", "ordinal", "note_text", F.col("start").alias("start_at"), F.col("end").alias("end_at"))


@query("id INTEGER, note_text VARCHAR, closed BOOLEAN", [(1, "[2024 c.12 §3 amends ORS 161.005 [nested] x.]", True), (2, "[2024 c.12 §3 amends ORS 1.005", False)])
def bracket_notes(spark):
    """Balanced bracket notes; one left open is told apart."""
    frame = spark.createDataFrame([(1, "A [2024 c.12 §3 amends ORS 161.005 [nested] x.] b [name]."), (2, "x [2024 c.12 §3 amends ORS 1.005")], "id int, body string")
    return statutes.bracket_notes(frame, "body", ["id"]).select("id", "note_text", F.col("end").isNotNull().alias("closed"))


@query("id INTEGER, found BOOLEAN, effective VARCHAR, edition INTEGER, status VARCHAR", [(1, True, "2025-01-01", None, "note_only"), (2, True, None, None, "note_only"), (3, False, None, 2023, "repealed")])
def dates_and_stubs(spark):
    """Effective dates, edition years and stubs."""
    frame = spark.createDataFrame([(1, "takes effect January 1, 2025"), (2, "effective February 31, 2025"), (3, "2023 EDITION\n[Repealed by 1971 c.1]")], "id int, t string")
    t = F.col("t")
    d = statutes.effective_date(t)
    return frame.select("id", d["found"].alias("found"), F.date_format(d["date"], "yyyy-MM-dd").alias("effective"), statutes.edition_year(t).alias("edition"), statutes.stub_kind(t)["status"].alias("status"))


@query("id INTEGER, category VARCHAR, disposition VARCHAR", [(1, "session_law_provision", "expected_scope"), (2, "unresolved", "review_required"), (3, "series_membership", "expected_scope")])
def diagnostic_triage(spark):
    """Diagnostics by the first rule that fits."""
    frame = spark.createDataFrame([(1, "r", "Section 3, chapter 1, Oregon Laws 2001, is amended to read:"), (2, "r", "odd"), (3, "existing ORS series membership", "x")], "id int, reason string, t string")
    s = statutes.triage(F.col("reason"), F.col("t"))
    return frame.select("id", s["category"].alias("category"), s["disposition"].alias("disposition"))


@query("doc_id VARCHAR, year INTEGER, chapter INTEGER, effective VARCHAR, status VARCHAR, amended VARCHAR, repealed VARCHAR, errors VARCHAR, counsel_status VARCHAR", [("a", 2023, 7, "2024-01-01", "Verified", "165.570", "180.650,180.660", "", "agrees"), ("b", 2024, 9, "2025-01-01", "ParsedUnverified", "1.005", "", "", "no-rows"), ("c", None, None, None, "Incomplete", "", "", "MissingCitation,MissingYear,MissingChapter,MissingEffectiveDate", "no-rows")])
def legacy_validation(spark):
    """Act summaries with evidence, validation and the counsel's table."""
    a = ["OREGON LAWS 2023", "Chap. 7", "HB 2001", "Relating to x; amending ORS 165.570; repealing ORS 180.650 and 180.660.", "SECTION 1. ORS 165.570 is amended to read: t. SECTION 2. ORS 180.650 and 180.660 are repealed. Effective date January 1, 2024"]
    b = ["OREGON LAWS 2024", "Chap. 9", "SB 5", "Relating to y; amending ORS 1.005."]
    frame = spark.createDataFrame([("a", a, "2023orlaw0007"), ("b", b, "2024orlaw0009"), ("c", ["x"], "y")], "doc_id string, paragraphs array<string>, location string")
    counsel = spark.createDataFrame([("165.570", "amended", 7, 2023), ("180.650", "repealed", 7, 2023), ("180.660", "repealed", 7, 2023)], "section string, action string, chapter int, year int")
    joined = lambda c: F.array_join(c, ",")
    return legacy.reconciled(legacy.read_acts(frame), counsel).select("doc_id", "year", "chapter", F.date_format("effective_date", "yyyy-MM-dd").alias("effective"), "status", joined("changes.amended").alias("amended"), joined("changes.repealed").alias("repealed"), joined("errors").alias("errors"), "counsel_status")


@query("number VARCHAR, version_ordinal INTEGER, catchline VARCHAR, body_text VARCHAR, status VARCHAR", [("90.100", 0, "Definitions.", "As used here.", "active"), ("90.110", 0, "", None, "repealed"), ("90.100", 1, "Definitions.", "Later.", "active")])
def chapter_sections(spark):
    """A chapter's sections, versions and stubs."""
    html = "<p><b>90.100 Definitions.</b> As used here. [1971 c.5 §1]</p><p><b>90.110</b> [Repealed by 1999 c.4 §2]</p><p><b>90.100 Definitions.</b> Later.</p>"
    frame = spark.createDataFrame([(90, html)], "chapter int, html string").withColumn("styled", styled.html_styled("html"))
    return segment.sections(frame, ["chapter"]).select("number", "version_ordinal", "catchline", "body_text", "status")


@query(
    "canonical_term VARCHAR, layperson_synonym VARCHAR, query_context VARCHAR",
    [("tenant", "a?", "layperson_question"), ("tenant", "b?", "layperson_question"), ("tenant", "c?", "layperson_question"), ("lease", "lease", "legal_term_of_art"), ("tenant", "renter", "synonym"), ("abode", "home", "synonym")],
)
def synonym_rows(spark):
    """Expansion payloads to synonym rows."""
    reply = '```json\n{"layperson_questions": ["a?", "b?", "c?"], "colloquial_synonyms": {"tenant": ["renter"], "abode": ["home"]}, "legal_terms_of_art": ["abode", "lease"]}\n```'
    frame = spark.createDataFrame([("90.100", reply, None), ("90.110", "no json", None)], "citation string, reply string, first_definition string").withColumn("payload", terms.parse_payload(F.col("reply")))
    return terms.synonym_rows(frame.filter(terms.is_valid_payload(F.col("payload")))).select("canonical_term", "layperson_synonym", "query_context")


@query("section VARCHAR, body VARCHAR, n_applied INTEGER", [("1.1", "uno two", 1), ("1.2", "a", 0)])
def edits_as_of(spark):
    """Dated edits applied up to and including a date."""
    schema = "preview_id string, predecessor string, section string, old string, new string, operative_date string"
    plans = spark.createDataFrame([("p1", None, "1.1", "one", "uno", "2024-01-01"), ("p2", "p1", "1.1", "uno", "eins", "2025-01-01")], schema).withColumn("operative_date", F.col("operative_date").cast("date"))
    return history.as_of(plans, spark.createDataFrame([("1.1", "one two"), ("1.2", "a")], "section string, body string"), "2024-01-01", spark)
