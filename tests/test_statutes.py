"""Text grammar on small invented fixtures."""

import datetime

import pytest
from pyspark.sql import functions as F

from lexloom.functions import acts, credits, keys, styled, text
from lexloom.operators import history, legacy, statutes


def row(spark, value, **columns):
    return spark.createDataFrame([(value,)], "t string").select(*[c.alias(n) for n, c in columns.items()]).first()


CREDITS = [
    ("[1971 c.743 §3; 1973 c.836 §339]", [("unspecified", 1971, None, 743, "3"), ("unspecified", 1973, None, 836, "339")]),
    ("[1971 c.743]", [("unspecified", 1971, None, 743, None)]),
    ("[Amended by 1961 c.160 §4; repealed by 1973 c.794 §34]", [("amended", 1961, None, 160, "4"), ("repealed", 1973, None, 794, "34")]),
    ("[1981 s.s. c.1 §3; 2002 s.s.3 c.6 §§7,7a]", [("unspecified", 1981, 1, 1, "3"), ("unspecified", 2002, 3, 6, "7"), ("unspecified", 2002, 3, 6, "7a")]),
    ("[2001 c.1 §8(2),(3)]", [("unspecified", 2001, None, 1, "8")]),
    ("[2009 c.431 §6 and 2009 c.816 §15]", [("unspecified", 2009, None, 431, "6"), ("unspecified", 2009, None, 816, "15")]),
    ("[repealed by 1979 c.43 §1 and by 1979 c.190 §431]", [("repealed", 1979, None, 43, "1"), ("repealed", 1979, None, 190, "431")]),
    ("[amendments by 2002 s.s.1 c.11 §1 repealed by 2002 s.s.2 c.1 §3]", [("amended", 2002, 1, 11, "1"), ("repealed", 2002, 2, 1, "3")]),
    ("[subsection (3) enacted as 1999 c.5 s.4 (1)]", [("enacted", 1999, None, 5, "4")]),
    ("[1983 cor. c.736 §1; Derived from 1961 c.2]", [("unspecified", 1983, None, 736, "1"), ("enacted", 1961, None, 2, None)]),
]


@pytest.mark.parametrize("raw,want", CREDITS)
def test_credits(raw, want):
    got = credits.parse_credit(raw)
    assert [(c["action"], c["session_year"], c["special_session"], c["session_law_chapter"], c["session_law_section"]) for c in got.citations] == want
    assert not got.unparsed


def test_credits_that_name_sections(spark):
    raw = "[Formerly 646.185; Renumbered 161.045 in 1971; enacted in lieu of 1.050; subsections (1) to (3) renumbered 192.411 and subsection (4) renumbered 192.401 in 2017; odd]"
    c = row(spark, raw, c=credits.credit_udf(F.col("t"))).c
    assert (c.formerly, c.renumbered, c.in_lieu, c.unparsed) == (["646.185"], ["161.045", "192.411", "192.401"], ["1.050"], ["odd"])


ACT = """<p>OREGON LAWS 2023 Chap. 12</p><p>AN ACT HB 2001</p><p>Relating to things; amending ORS 161.005; repealing ORS 161.015.</p>
<p>SECTION 1. ORS 161.005 is amended to read:</p><p>161.005. The [<i>old</i>] <b>new</b> text.</p>
<p>SECTION 2. ORS 161.015 and 161.025 are repealed.</p><p>SECTION 3. Sections 4 and 5 of this 2023 Act are added to and made a part of ORS chapter 161.</p>
<p>SECTION 4. A fresh duty.</p><p>SECTION 5. ORS 161.035 is repealed.</p><p>SECTION 6. ORS 1.010 to 1.050 are repealed.</p><p>Approved by the Governor</p>"""


def test_session_acts(spark):
    frame = spark.createDataFrame([("a", ACT), ("b", "<p>no act</p>"), ("c", None), ("d", ACT.replace("[<i>old</i>]", "[old"))], "doc_id string, markup string")
    rows = acts.session_rows(frame).collect()
    done = [(r.action_type, r.affected_section, r.session_law_section) for r in rows if r.doc_id == "a" and r.kind == "action"]
    assert done == [("AMEND", "161.005", "1"), ("REPEAL", "161.015", "2"), ("REPEAL", "161.025", "2"), ("ADD", None, "4"), ("REPEAL", "161.035", "5")]
    tokens = next(r.tokens for r in rows if r.action_type == "AMEND")
    assert [(t.operation, t.text) for t in tokens if t.operation in ("ADD", "DELETE")] == [("DELETE", "old"), ("ADD", "new")]
    body = next(r.raw_diff_text for r in rows if r.action_type == "AMEND")
    assert all(body[t.start : t.end] == t.text for t in tokens)
    assert [r.reason for r in rows if r.kind == "diagnostic"] == ["repeal range requires an edition roster"]
    assert {r.doc_id for r in rows if r.kind == "error"} == {"b", "c", "d"}


def test_members_conditions_and_identity():
    assert acts.member_numbers("2, 3 and 5 to 7") == ["2", "3", "5", "6", "7"]
    series = acts.read_act(ACT.replace("SECTION 3. Sections 4 and 5 of this 2023 Act", "SECTION 3. Section 4 of this 2023 Act and ORS 161.045"))
    assert [a["session_law_section"] for a in series.actions if a["action_type"] == "ADD"] == ["4"]
    assert [d["reason"] for d in series.diagnostics] == ["existing ORS series membership", "repeal range requires an edition roster"]
    guarded = acts.read_act(ACT.replace("SECTION 2. ORS", "SECTION 2. If Senate Bill 308 becomes law, ORS"))
    assert [a["condition_text"] for a in guarded.actions if a["affected_section"] == "161.015"] == ["If Senate Bill 308 becomes law"]
    regular, special = acts.read_act(ACT), acts.read_act(ACT.replace("2023 Chap. 12", "2023 (second special session) Chap. 12"))
    assert special.who.special_session == 2 and not {a["id"] for a in regular.actions} & {a["id"] for a in special.actions}


def test_phrases_and_more_acts():
    from lexloom.functions.phrases import match, tokens_of

    words = tokens_of("ORS 5.010, as changed, is amended\nto read: x")
    found = match("ORS {section} , ... is amended to read :", words)
    assert [words[a].text for a, _ in found.parts] == ["5.010", "as"] and words[found.end - 1].text == ":"
    assert match("ORS {section} is amended", words) is None and match("... never", words) is None
    noted = acts.read_act(ACT.replace("SECTION 2. ORS 161.015 and 161.025 are repealed.", "SECTION 2. (1) ORS 161.015 is repealed. (2) More.").replace("SECTION 5. ORS 161.035 is repealed.", "SECTION 5. ORS 161.035 is created."))
    assert [d["reason"] for d in noted.diagnostics][0] == "remaining numbered provisions" and noted.diagnostics[0]["text"] == "(2) More."
    assert ("ADD", "161.035") in {(a["action_type"], a["affected_section"]) for a in noted.actions}
    for broken in (ACT.replace("2023 Chap. 12", "2023 (special session) Chap. 12"), ACT.replace("SECTION 2.", "SECTION 1."), ACT.replace("HB 2001", "none"), ACT.replace("LAWS 2023", "LAWS")):
        with pytest.raises(acts.ActError):
            acts.read_act(broken)


def test_markup_and_tokens(spark):
    got = row(spark, "<p><b>A</b> co-<br>operate ﬁ</p><script>x</script><p style='font-weight: 700'>pre<u>mid</u></p>", s=styled.html_styled(F.col("t"))).s
    assert got.text == "\nA cooperate fi\npremid\n"
    assert [(got.text[r.start : r.end], r.bold, r.underline) for r in got.runs] == [("A", True, False), ("pre", True, False), ("mid", True, True)]
    assert row(spark, "a [b", x=styled.tokens_udf(F.struct(F.col("t").alias("text"), F.array().cast("array<struct<start:int,end:int,bold:boolean,underline:boolean>>").alias("runs")))).x.ok is False
    assert styled.decode_bytes("é".encode()) == ("é", "utf-8") and styled.decode_bytes(b"charset=latin-1 \xe9")[0].endswith("é") and styled.decode_bytes(b"\x93x")[1] == "cp1252"


def test_references(spark):
    frame = spark.createDataFrame([(1, "ORS 1.194 to 1.200 apply. See ORS 90.100 and ORS chapter 279A; chapter 88, Oregon Laws 2025."), (2, None)], "id int, body string")
    refs = statutes.references(frame, "body", ["id"])
    got = refs.orderBy("start").collect()
    assert [(r.kind, r.text) for r in got] == [("range", "1.194 to 1.200"), ("section", "90.100"), ("chapter", "chapter 279A")]
    body = frame.first().body
    assert all(body[r.start : r.end] == r.text for r in got)
    known = spark.createDataFrame([("1.200", "s1")], "number string, section_id string")
    assert sorted((r.number or "", r.section_id or "") for r in statutes.resolved(refs, known).collect()) == [("", ""), ("1.194", ""), ("1.200", "s1"), ("90.100", "")]


def test_notes_notices_and_brackets(spark):
    frame = spark.createDataFrame([(1, "Body text. Note: first one.  Notes: second "), (2, "nothing")], "id int, body string")
    notes = statutes.note_blocks(frame, "body", ["id"]).orderBy("start").collect()
    assert [(n.ordinal, n.note_text) for n in notes] == [(1, "Note: first one."), (2, "Notes: second")]
    assert all(frame.first().body[n.start : n.end] == n.note_text for n in notes)
    series = "New sections of law were added by legislative action to this ORS chapter or to a series within this ORS chapter by the Legislative Assembly during its 2026 regular session. See sections in the following 2026 Oregon Laws chapters: 2026 Session Laws 0011; 0017"
    table = "ORS sections in this chapter were amended or repealed by the Legislative Assembly during its 2026 regular session. See the table of ORS sections amended or repealed during the 2026 regular session: 2026 A&R Tables"
    lines = spark.createDataFrame([(series,), (table,), (table.replace("session: 2026", "session: 2025"),)], "line string")
    assert sorted((n.change_kind, n.session_law_chapter or 0) for n in statutes.notices(lines).collect()) == [("amended_or_repealed_elsewhere", 0), ("new_series_section", 11), ("new_series_section", 17)]
    brackets = spark.createDataFrame([(1, "Before [2024 c.12 §3 amends ORS 161.005 [with a nested note].] after [name]."), (2, "x [2024 c.12 §3 amends ORS 1.005")], "id int, body string")
    got = {n.id: (n.note_text, n.end) for n in statutes.bracket_notes(brackets, "body", ["id"]).collect()}
    assert got[1][0] == "[2024 c.12 §3 amends ORS 161.005 [with a nested note].]" and got[2][1] is None


def test_definitions(spark):
    body = 'As used in this chapter:\n(1) "Attorney fees" means fees.\n(2)(a) "Animal" includes pets.\n(b) more\n(3) "Holder" or "keeper" means: (a) one; or (b) two.'
    frame = spark.createDataFrame([("1.1", body), ("1.2", '(1) "X" means y.')], "c string, t string")
    got = [(r.defined_term, r.definition_text) for r in statutes.definitions(frame, "t", "c").collect()]
    assert got == [("Attorney fees", "fees."), ("Animal", "includes pets. (b) more."), ("Holder", "(a) one; or (b) two."), ("keeper", "(a) one; or (b) two.")]


def test_dates_editions_stubs_and_triage(spark):
    date = lambda t: row(spark, t, d=statutes.effective_date(F.col("t"))).d
    assert date("becomes effective January 1, 2025").date == datetime.date(2025, 1, 1) and date("takes effect on 2024-02-03").date == datetime.date(2024, 2, 3)
    assert date("effective February 31, 2025") == (True, None) and date("none") == (False, None)
    edition = lambda t: row(spark, t, e=statutes.edition_year(F.col("t"))).e
    assert [edition(t) for t in ("2023 EDITION", "2023\nEDITION", "Edition: 2023", "2023 ORS EDITION")] == [2023] * 4
    assert edition("2023 EDITION\n2021 EDITION") is None and edition("the 1991 Edition of it") is None
    stub = lambda t: tuple(row(spark, t, s=statutes.stub_kind(F.col("t"))).s)
    assert stub("[Repealed by 1971 c.1]") == ("repealed", None) and stub("[Renumbered 1.005]") == ("renumbered", "1.005") and stub("x") == ("note_only", None)
    sort = lambda t: row(spark, t, s=statutes.triage(F.lit("r"), F.col("t"))).s.category
    assert sort("Section 3, chapter 1, Oregon Laws 2001, is amended to read:") == "session_law_provision" and sort("odd") == "unresolved"
    assert sort("If any provision of section 2 is repealed, it does not affect the validity of any action") == "incidental_repeal_reference"


def test_legacy_acts(spark):
    paragraphs = [
        "OREGON LAWS 2023", "Chap. 7", "HB 2001", "Relating to x; amending ORS 165.570; repealing ORS 180.650 and 180.660.",
        "SECTION 1. ORS 165.570 is amended to read: text. SECTION 2. ORS 180.650 and 180.660 are repealed. Effective date January 1, 2024",
    ]
    frame = spark.createDataFrame([("a", paragraphs, "2023orlaw0007.pdf"), ("b", ["nothing"], "x")], "doc_id string, paragraphs array<string>, location string")
    got = {r.doc_id: r for r in legacy.read_acts(frame).collect()}
    a = got["a"]
    assert (a.bill.kind, a.bill.number, a.year, a.chapter, a.effective_date, a.status, a.errors) == ("HB", 2001, 2023, 7, datetime.date(2024, 1, 1), "Verified", [])
    assert (a.changes.amended, a.changes.repealed) == (["165.570"], ["180.650", "180.660"])
    assert got["b"].status == "Incomplete" and len(got["b"].errors) == 4
    rows = spark.createDataFrame([("165.570", "amended", 7, 2023), ("180.650", "repealed", 7, 2023), ("180.660", "repealed", 7, 2023), ("1.001", "added_to", 7, 2023)], "section string, action string, chapter int, year int")
    assert {r.doc_id: r.counsel_status for r in legacy.reconciled(legacy.read_acts(frame), rows).collect()} == {"a": "agrees", "b": "no-rows"}


def test_histories(spark):
    body = spark.createDataFrame([("1.1", "one two"), ("1.2", "a a")], "section string, body string")
    schema = "preview_id string, predecessor string, section string, old string, new string, operative_date date, reference_id string"
    d = datetime.date
    plans = spark.createDataFrame([("p1", None, "1.1", "one", "uno", d(2024, 1, 1), "r1"), ("p2", "p1", "1.1", "uno", "eins", d(2025, 1, 1), "r2"), ("p3", "gone", "1.2", "a", "b", d(2024, 1, 1), "r3"), ("c1", "c2", "1.2", "a", "b", d(2024, 1, 1), None), ("c2", "c1", "1.2", "a", "b", d(2024, 1, 1), None)], schema)
    assert {tuple(r) for r in history.chain_problems(plans, spark).collect()} == {("p3", "missing-predecessor"), ("c1", "cycle"), ("c2", "cycle")}
    state = lambda date: {r.section: (r.body, r.n_applied) for r in history.as_of(plans.filter("preview_id like 'p%'"), body, date, spark).collect()}
    assert state("2024-01-01")["1.1"] == ("uno two", 1) and state("2025-06-01")["1.1"] == ("eins two", 2) and state("2023-01-01")["1.1"] == ("one two", 0)
    reviewed = plans.join(body, "section").withColumn("body_sha256", history.text_digest(F.col("body"))).drop("body")
    got = {r.preview_id: (r.problem, r.preview) for r in history.previews(reviewed, body).collect()}
    assert got["p1"] == (None, "uno two") and got["p3"][0] == "not-exactly-once"
    refs = spark.createDataFrame([("1.1", "r1"), ("1.1", "r2"), ("1.3", "r9")], "section string, reference_id string")
    assert {r.reference_id: r.status for r in history.catalog(refs, plans, "2024-06-01").collect()} == {"r1": "applied", "r2": "scheduled", "r9": "needs-text-review"}


def test_keys_and_text(spark):
    got = spark.createDataFrame([("279a",), ("ORS 90.100",), ("x",)], "t string").select(keys.chapter_sort_key(F.col("t")), keys.citation(F.col("t")), keys.chapter_stem(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [("000279A", None, "ors279a"), ("999999~", "90.100", None), ("999999~", None, None)]
    assert tuple(row(spark, "12A to 20", r=keys.chapter_range(F.col("t"))).r) == ("12A", "20", "000012A", "000020 ")
    assert row(spark, "a\nb  b\n\n", s=text.line_spans(F.col("t"))).s == [("a", 0, 1), ("b  b", 2, 6)]
    assert row(spark, "can't stop—now", s=text.lexemes(F.col("t"))).s == ["can't", "stop", "—", "now"]
