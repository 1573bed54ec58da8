"""Rosters and reviews on small invented fixtures."""

from pyspark.sql import functions as F

from lexloom.operators import reviews, roster

TABLE = ["Volume 1", "Title 1  Courts – Chs. 1-10", "2 Procedure – Chs. 12 – 36A", "LANDLORD-", "Title 3 A very long name", "that wraps – Chs. 40-45", "Volume 2", "Title 4 Alone –", "Chs. 50", "5 Never done", "Title 6 Odd – Chs. xx", "1 Again – Chs. 99"]


def test_titles_volumes_and_covers(spark):
    lines = spark.createDataFrame([("d", i, t) for i, t in enumerate(TABLE)], "doc string, n int, line string")
    found = roster.titles(lines, ["doc"])
    got = {(r.kind, r.number, r.name, r.volume, r.first, r.last) for r in found.collect()}
    assert got == {
        ("title", "1", "Courts", 1, "1", "10"), ("title", "2", "Procedure", 1, "12", "36A"), ("title", "3", "A very long name that wraps", 1, "40", "45"),
        ("title", "4", "Alone", 2, "50", "50"), ("unresolved", "5", None, 2, None, None), ("unparsed", "6", "Odd", 2, None, None),
    }
    assert {(r.volume, r.first_chapter, r.last_chapter, r.n_titles) for r in roster.volumes(found, ["doc"]).collect()} == {(1, "1", "45", 3), (2, "50", "50", 1)}
    chapters = spark.createDataFrame([("36A",), ("11",), ("050",)], "c string")
    assert {r.c: r.title for r in roster.covering_title(chapters, "c", found).collect()} == {"36A": "2", "11": None, "050": "4"}
    assert [r.digits for r in roster.candidate_chapters(found).collect()][:3] == [1, 2, 3]


def test_probes_headings_and_stubs(spark):
    probes = spark.createDataFrame([("1", i, i != 2) for i in range(4)] + [("2", 0, True)], "f string, i int, ok boolean")
    assert {(r.f, r.i) for r in roster.family_prefix(probes, "f", "i", "ok").collect()} == {("1", 0), ("1", 1), ("2", 0)}
    lines = spark.createDataFrame([("d", 0, "Chapter 12 — Front"), ("d", 90, "Chapter 90 — Tenancy"), ("d", 91, "90.110 [Repealed]"), ("d", 92, "90.120 [1971 c.1]")], "doc string, n int, line string")
    assert tuple(roster.chapter_heading(lines, ["doc"], F.lit("90")).first()) == ("d", "90", "Tenancy")
    assert tuple(roster.chapter_heading(lines, ["doc"]).first()) == ("d", "12", "Front")
    anchored = spark.createDataFrame([("d", "90.110")], "doc string, number string")
    assert [r.number for r in roster.unanchored_stubs(lines, anchored, ["doc"]).collect()] == ["90.120"]
    row = spark.createDataFrame([("2023 EDITION 1850 EDITION\n\nb",)], "t string").select(roster.plausible_edition(F.col("t")), roster.sample_lines(F.col("t"))).first()
    assert tuple(row) == (2023, ["2023 EDITION 1850 EDITION", "b"])


def test_references(spark):
    sha = "a" * 64
    evidence = lambda action, text="t": [("1.1", action, "OperativeBodyEvidence", "2", text)]

    def result(chapter, year=2026, bill=5, amended=("1.1",), repealed=(), ev=None, errors=(), url="u"):
        return (chapter, (list(errors), year, chapter, (sha, url), ("HB", bill), (list(amended), list(repealed)), (evidence("AmendmentAction") if ev is None else ev,)))

    results = [result(1), result(2, errors=["x"]), result(3, year=1), result(4, url="v"), result(5, bill=6), result(6, ev=evidence("RepealAction")), result(7, amended=()), result(8, amended=(), repealed=["1.1"]), result(9, ev=[]), result(10, ev=evidence("AmendmentAction", " ")), (11, None)]
    frame = spark.createDataFrame(results, f"chapter int, result struct<{reviews.RESULT.replace(' array', ':array').replace(' int', ':int').replace(' struct', ':struct')}>")
    refs = spark.createDataFrame([("1.1", "A", c, "2", "HB 5", 2026) for c in range(1, 13)], "section string, action string, chapter int, clause string, measure string, session_year int")
    got = spark.createDataFrame([(c, True, sha, "u") for c in range(1, 13)], "chapter int, ok boolean, sha256 string, source_url string")
    verified = reviews.verified_references(refs, frame, got)
    assert [r.status for r in verified.orderBy("chapter").collect()] == [
        "exact-match", "parser-error", "identity-mismatch", "provenance-mismatch", "measure-mismatch", "conflicting-action", "missing-affected-section",
        "conflicting-action", "missing-operative-evidence", "invalid-result", "invalid-result", "missing-result",
    ]
    assert tuple(reviews.verification_gate(verified).first()) == (12, 1, False)


def test_notices_notes_and_sets(spark):
    pending = spark.createDataFrame([(2026, 1), (2026, 2), (2026, 3), (2026, None)], "session_year int, session_law_chapter int")
    results = spark.createDataFrame([(2026, 1, "parsed"), (2026, 2, "invalid-json")], "session_year int, session_law_chapter int, status string")
    assert tuple(reviews.reconciliation_counts(reviews.reconciled_notices(pending, results)).first()) == (4, 1, 1, 1, 1, False)
    schema = "section_id string, ordinal int, note_kind string, note_text string, start int, end int"
    a = spark.createDataFrame([("s", 1, "k", "a b", 0, 3), ("s", 2, "k", "c", 5, 6), ("t", 1, "k", "x", 0, 1)], schema)
    b = spark.createDataFrame([("s", 1, "k", "a  b", 0, 4), ("s", 2, "k", "d", 5, 9), ("u", 2, "k", "y", 0, 1)], schema)
    assert {(r.section_id, r.ordinal): r.state for r in reviews.compared_notes(a, b).collect()} == {("s", 1): "matched", ("s", 2): "mismatched", ("t", 1): "missing", ("u", 2): "extra"}
    assert {(r.section_id, r.problem) for r in reviews.note_problems(b).collect()} == {("s", "offsets"), ("u", "ordinals")}
    both = spark.createDataFrame([(1, ["1.1", "1.2"], ["2.1"])], "d int, am array<string>, re array<string>")
    want = reviews.pairs(both, F.col("am"), F.col("re"), ["d"])
    have = spark.createDataFrame([(1, "amended", "1.1"), (1, "repealed", "1.2")], "d int, action string, section string")
    assert tuple(reviews.conflicts(want, have, ["d"]).first()) == (1, ["repealed 1.2"], ["amended 1.2", "repealed 2.1"])
    assert {tuple(r) for r in reviews.coverage_gaps(want, have, "section").collect()} == {("2.1", "left")}
    tags = spark.createDataFrame([(["a", "z"],)], "tags array<string>")
    assert reviews.expanded_tags(tags, "tags", {"a": ["b", "c"]}).first().tags == ["a", "b", "c", "z"]
    rows = spark.createDataFrame([("ok", "a" * 64, "a" * 64, "u", "u"), (None, "x", None, "u", "v")], "status string, sha256 string, expected_sha256 string, url string, expected_url string")
    assert sorted(len(r.problems) for r in reviews.provenance_problems(rows).collect()) == [0, 4]
