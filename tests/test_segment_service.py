"""Chapters to sections, the service questions, terms, and the inbox stream."""

import json

import pytest
from pyspark.sql import functions as F

from lexloom.functions import styled, text
from lexloom.operators import markup, relational, search, segment, service, statutes, terms
from lexloom.streaming import inbox

CHAPTER = """<p>2023 EDITION</p><p><b>90.100 Definitions.</b> As used here. [1971 c.5 §1; 2001 c.2 §3]</p><p><b>90.110</b> [Repealed by 1999 c.4 §2]</p>
<p><b>90.100 Definitions,</b> <b>later.</b> Later text with (see 90.110). [1971 c.5 §1]</p><p>Not <b>90.999 an anchor</b> here.</p>"""


def test_sections_versions_and_stubs(spark):
    frame = spark.createDataFrame([(90, CHAPTER)], "chapter int, html string").withColumn("styled", styled.html_styled("html"))
    rows = segment.sections(frame, ["chapter"])
    got = [(r.number, r.version_ordinal, r.catchline, r.body_text, r.source_credit, r.status) for r in rows.orderBy("position").collect()]
    assert got == [
        ("90.100", 0, "Definitions.", "As used here.", "[1971 c.5 §1; 2001 c.2 §3]", "active"),
        ("90.110", 0, "", None, "[Repealed by 1999 c.4 §2]", "repealed"),
        ("90.100", 1, "Definitions, later.", "Later text with (see 90.110). Not 90.999 an anchor here.", "[1971 c.5 §1]", "active"),
    ]
    assert segment.integrity(rows, ["chapter"]).count() == 0


def test_service(spark):
    d = {
        "editions": ([(2023,)], "edition_year int"), "chapters": ([("90",)], "chapter_number string"), "diagnostics": ([("d",)], "id string"),
        "diagnostic_reviews": ([("expected_scope",), ("expected_scope",)], "disposition string"), "build_metadata": ([("manifest", "m"), ("built", "now")], "key string, value string"),
        "sections": ([(2023, "90.100", "90"), (2023, "90.110", "90")], "edition_year int, ors_section string, chapter_number string"),
        "chapter_sources": ([(2023, "90", "u")], "edition_year int, chapter_number string, source_url string"), "sources": ([("u", "h")], "source_url string, sha256 string"),
        "section_versions": ([(2023, "90.100", 0, "Definitions", "tenant rules", "active"), (2023, "90.110", 0, "Definitions", "tenant duties", "active"), (2023, "90.100", 1, "Definitions", "unicorn", "active")], "edition_year int, ors_section string, version_ordinal int, catchline string, content_text string, status string"),
        "section_notes": ([(2023, "90.100", 2, "Note: y"), (2023, "90.100", 1, "Note: x")], "edition_year int, ors_section string, id int, note_text string"),
        "amendments": ([("a1", "HB 1", 2023, "90.100", "AMEND", "x" * 600), ("a2", "HB 2", 2021, "90.100", "AMEND", None)], "id string, bill_number string, session_year int, affected_ors_section string, action_type string, raw_diff_text string"),
        "amendment_sources": ([("a1", "u")], "amendment_id string, source_url string"), "amendment_context": ([("a1", "if", "all")], "amendment_id string, condition_text string, operative_text string"),
        "pending_changes": ([("p2", "90.100", "HB 3", "2024-01-01", "n"), ("p1", "90.100", "HB 2", None, "n")], "id string, target_section string, enacting_measure string, effective_date string, note_text string"),
        "pending_change_sources": ([("p1", 2023, "u")], "pending_change_id string, edition_year int, source_url string"),
    }
    t = lambda name: spark.createDataFrame(*d[name])
    first = service.search_sections(t, "tenant", limit=1)
    assert len(first.collect()) == 2 and (first.first().excerpt, first.first().source_url) == ("[tenant] rules", "u")
    one = search.envelope(first, 1).first()
    assert (len(one["items"]), one["items"][0].id, one.next_offset) == (1, "ors:2023:90.100:v0", 1) and search.envelope(service.search_sections(t, "unicorn"), 10).first().next_offset is None
    assert [r.id for r in service.search_sections(t, "unicorn").collect()] == ["ors:2023:90.100:v1"]
    assert [r.version_ordinal for r in service.search_sections(t, "ors 90.100").collect()] == [0, 1]
    # a filter hides rows and changes no rank
    assert {r.rank for r in service.search_sections(t, "rules").collect()} == {r.rank for r in service.search_sections(t, "rules", chapter=" 90").collect()}
    assert service.search_sections(t, "tenant unicorn").count() == 0 and service.search_sections(t, "tenant", edition=1999).count() == 0
    for wrong in ({"query": " "}, {"query": "x" * 301}, {"query": "?!"}, {"query": "x", "chapter": "0"}, {"query": "x", "limit": 0}, {"query": "x", "offset": -1}):
        with pytest.raises(ValueError):
            service.search_sections(t, **wrong)
    one = service.get_section(t, "ors 90.100", 2023).first()
    assert len(one.versions) == 2 and [n.note_text for n in one.notes] == ["Note: x", "Note: y"] and one.sources[0].sha256 == "h" and one.section.chapter_number == "90"
    assert service.get_section(t, "90.110", 2023).first().notes == []
    with pytest.raises(LookupError):
        service.get_section(t, "90.100", 1999)
    with pytest.raises(ValueError):
        service.get_amendments(t, "tenant")
    b, a = service.get_amendments(t, "90.100").collect()
    assert (b.id, a.text_truncated, len(a.raw_diff_text), a.source_url, a.condition_text, a.operative_text) == ("a2", True, 500, "u", "if", None)
    whole = service.get_amendments(t, "90.100", session_year=2023, include_text=True).collect()
    assert [(r.text_truncated, len(r.raw_diff_text), r.operative_text) for r in whole] == [(False, 600, "all")]
    assert [r.id for r in service.get_pending_changes(t, "90.100").collect()] == ["p1", "p2"] and service.get_pending_changes(t, "90.100", edition=2023).count() == 1
    info = {(r.part, r.name): r.value for r in service.dataset_info(t).collect()}
    assert info["count", "section_versions"] == "3" and info["review", "expected_scope"] == "2" and len(info["build", "manifest_sha256"]) == 64 and ("session_year", "2021") in info


def test_indexes_and_positions(spark, tmp_path):
    docs = spark.createDataFrame([(i, "head" if i % 3 else "rare", "common " * (1 + i % 4) + ("rare" if i % 5 == 0 else "")) for i in range(300)] + [(300, None, "")], "id long, a string, b string")
    search.write_ranked_index(docs, "id", ["a", "b"], f"{tmp_path}/index")
    for words in ("common rare", "rare", "absent common", ""):
        want = {r.id: round(r.score, 9) for r in search.bm25(docs, {"a": 5.0, "b": 1.0}, words).collect()}
        assert {r.key: round(r.score, 9) for r in search.ranked(spark, f"{tmp_path}/index", {"a": 5.0, "b": 1.0}, words).collect()} == want
    index = search.inverted_index(docs, "id", ["a", "b"], block=16)
    assert index.agg(F.max("n")).first()[0] < 60
    assert {r.id for r in search.and_search_index(index, "Rare common").collect()} == {r.id for r in search.and_search(docs, "id", ["a", "b"], "Rare common").collect()}
    assert search.and_search_index(index, "").count() == 0
    found = search.positions(docs, [F.col("b").desc(), "id"]).orderBy("position").collect()
    assert [r.position for r in found] == list(range(1, 302)) and [r.id for r in found] == [r.id for r in docs.orderBy(F.col("b").desc(), "id").collect()]


def test_terms(spark):
    payload = {"layperson_questions": ["a?", "b?", "c?"], "colloquial_synonyms": {"tenant": ["renter"], "abode": ["home"]}, "legal_terms_of_art": ["abode", "lease"]}
    frame = spark.createDataFrame([("90.100", "```json\n" + json.dumps(payload) + "\n```", None), ("90.110", "{bad", "x")], "citation string, reply string, first_definition string")
    frame = frame.withColumn("payload", terms.parse_payload(F.col("reply")))
    assert {r.citation: r.ok for r in frame.select("citation", terms.is_valid_payload(F.col("payload")).alias("ok")).collect()} == {"90.100": True, "90.110": False}
    rows = terms.synonym_rows(frame.filter(terms.is_valid_payload(F.col("payload"))))
    want = {("tenant", q, "layperson_question") for q in ("a?", "b?", "c?")} | {("lease", "lease", "legal_term_of_art"), ("tenant", "renter", "synonym"), ("abode", "home", "synonym")}
    assert {tuple(r)[1:] for r in rows.collect()} == want
    definitions = spark.createDataFrame([("90.100", "Dwelling", "means x.", 1)], "citation string, defined_term string, definition_text string, n int")
    once = terms.with_definition_keys(rows, definitions)
    assert once.count() == rows.count() + 1 == terms.with_definition_keys(once, definitions).count()
    got = terms.expand_query(once, "my renter").first()
    assert (got.matched_canonical_terms, got.alternative_phrases) == (["tenant"], ["renter"]) and terms.expand_query(once, "  ").first().ors_citations == []
    new = spark.createDataFrame([("90.100", "t", "p", "key")], "citation string, canonical_term string, layperson_synonym string, query_context string")
    assert terms.upserted(once, new, "citation").count() == 1 and terms.first_definitions(definitions, "n").first().first_definition == "Dwelling"
    asked = definitions.select(terms.prompt(F.col("citation"), F.lit(None).cast("string"), F.lit("body"), F.array(F.struct("defined_term", "definition_text")))).first()[0]
    assert "(untitled)" in asked and '- "Dwelling": means x.' in asked


def test_more_text_operators(spark):
    one = lambda v, c: spark.createDataFrame([(v,)], "t string").select(c.alias("c")).first().c
    t = F.col("t")
    assert one("to amend-\ned and Amend-\nments of well-\nknown", text.critical_words_repaired(t)) == "to amended and Amendments of well-known"
    words = " ".join(f"w{i}" for i in range(100))
    assert one(words, search.snippet(t, "w60 w62", 5)) == " … w58 w59 [w60] w61 [w62] … " and one("a b", search.snippet(t, "b", 5)) == "a [b]"
    assert one("see chapter 5, Oregon Laws 2023", statutes.enacting_measure(t)) == "chapter 5, Oregon Laws 2023" and one("x", statutes.enacting_measure(t)) is None
    assert [tuple(c) for c in one("a Note: b", statutes.note_candidates(t))] == [("Note:", "Note: b")]
    notes = spark.createDataFrame([(2023, "90", None, 0, "note", "HB 5 amends, effective January 1, 2025"), (2023, "90", "90.1", 1, "source_credit", "amended"), (2023, "90", "90.1", 2, "note", "takes effect February 30, 2025")], "edition_year int, chapter_number string, section string, ordinal int, kind string, note_text string")
    got = sorted((r.enacting_measure or "", str(r.effective_date), r.bad_date) for r in statutes.pending_changes(notes).collect())
    assert got == [("", "None", True), ("HB 5", "2025-01-01", False)]
    pages = spark.createDataFrame([("http://h/a/b", '<a href="../c?x=1&amp;y=2">x</a><a href="d">y</a><a href="d">z</a>')], "url string, html string")
    assert [r.url for r in markup.resolved_links(pages, "url").collect()] == ["http://h/a/d", "http://h/c?x=1&y=2"]
    a, b = (spark.createDataFrame([(1, "x", v)], "k int, p string, q int") for v in (1, None))
    assert [tuple(r) for r in relational.field_changes(a, b, "k", ["p", "q"]).collect()] == [(1, "q", "1", None)]
    assert relational.nested(a, "k", {"kids": (b, ["p", "q"])}).first().kids[0].p == "x"
    stubs = spark.createDataFrame([(1, "<i>90.1234</i> [Repealed]", "90.1234 [Repealed] 90.110 [x]", ["90.110"])], "id int, m string, t string, have array<string>")
    assert [r.number for r in statutes.stub_contexts(stubs, "m", "t", "have", ["id"]).collect()] == ["90.1234"]


def test_inbox(spark, tmp_path):
    box = tmp_path / "in"
    box.mkdir()
    args = (f"{tmp_path}/table", f"{tmp_path}/state", "k string, v int, at int", "k", "at")
    for i, rows in enumerate(([("a", 1, 1), ("b", 2, 1)], [("a", 9, 2)])):
        (box / f"{i}.json").write_text("\n".join(json.dumps(dict(zip(("k", "v", "at"), r))) for r in rows))
        inbox.run_inbox(spark, str(box), *args).awaitTermination()
    assert {r.k: r.v for r in inbox.read_inbox_table(spark, args[0], "k", "at").collect()} == {"a": 9, "b": 2}
