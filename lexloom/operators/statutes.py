"""Statute text to rows with native expressions: notes, notices, references, definitions, stubs, dates, triage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions.styled import find_spans_udf
from lexloom.functions.text import context

NUMBER = "\\d{1,3}[A-Z]?\\.\\d{3,4}"
YEAR = "(?:18|19|20|21)\\d{2}"
#: Wordings of publications (fixed values).
_NOTICES = (
    (
        "amended_or_repealed_elsewhere",
        "ORS sections in this chapter were amended or repealed by the Legislative Assembly during its ((?:18|19|20)\\d{2}) regular session\\. "
        "See the table of ORS sections amended or repealed during the \\1 regular session: \\1 A&R Tables()",
    ),
    (
        "new_series_section",
        "New sections of law were added by legislative action to this ORS chapter or to a series within this ORS chapter by the Legislative Assembly "
        "during its ((?:18|19|20)\\d{2}) regular session\\. See sections in the following \\1 Oregon Laws chapters: (.+)$",
    ),
    (
        "new_compiled_section",
        "New sections of law were enacted by the Legislative Assembly during its ((?:18|19|20)\\d{2}) regular session and pertain to or are likely to be "
        "compiled in this ORS chapter\\. See sections in the following \\1 Oregon Laws chapters: (.+)$",
    ),
)
_DATE = "(?i)\\b(?:effective(?:\\s+date)?|takes\\s+effect)\\s+(?:on\\s+)?([A-Z][a-z]+\\s+\\d{1,2},\\s+\\d{4}|\\d{4}-\\d{2}-\\d{2})"
_BRACKET = f"\\[\\s*(?:Series\\s+enacted\\s+into\\s+law\\s+but\\s+not\\s+added\\s+to\\s+ORS\\b|{YEAR}\\s+c\\.\\s*\\d+\\s+§\\s*\\w+\\s+(?:amends?|repeals?|adds?)\\s+ORS\\b)"


def note_blocks(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """Editorial notes: keys, ordinal (from 1), note_text, start, end; offsets into the text.

    A note runs from its introducer to the next one or the text's end. The text is split before each introducer, so a
    running sum of the parts' lengths gives the offsets.
    """
    parts = df.select(*keys, F.posexplode(F.split(text, "(?=\\bNotes?:\\s)")).alias("i", "part"))
    before = Window.partitionBy(*keys).orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("at", F.coalesce(F.sum(F.length("part")).over(before), F.lit(0)))
    notes = parts.filter(F.col("part").rlike("^Notes?:\\s"))
    lead = F.length("part") - F.length(F.regexp_replace("part", "^\\s+", ""))
    body = F.regexp_replace(F.regexp_replace("part", "^\\s+", ""), "\\s+$", "")
    numbered = notes.withColumn("ordinal", F.row_number().over(Window.partitionBy(*keys).orderBy("i")))
    return numbered.select(*keys, "ordinal", body.alias("note_text"), (F.col("at") + lead).cast("int").alias("start"), (F.col("at") + lead + F.length(body)).cast("int").alias("end"))


def notices(lines: DataFrame, line: str = "line") -> DataFrame:
    """Pending-change notices: one row per chapter named, with a null chapter where a notice names none."""
    found = F.lit(None).cast("struct<kind:string,year:int,chapters:string>")
    for kind, pattern in reversed(_NOTICES):
        item = F.struct(F.lit(kind).alias("kind"), F.regexp_extract(line, pattern, 1).try_cast("int").alias("year"), F.regexp_extract(line, pattern, 2).alias("chapters"))
        found = F.when(F.col(line).rlike(pattern), item).otherwise(found)
    noticed = lines.withColumn("_n", found).filter("_n is not null")
    full, bare = "(?i)^(?:chapter|c\\.)\\s*0*(\\d+)", "^(?:\\d{4}\\s+Session\\s+Laws\\s+)?0*(\\d+)"
    number = lambda s: F.coalesce(F.regexp_extract(s, full, 1).try_cast("int"), F.regexp_extract(s, bare, 1).try_cast("int"))
    named = F.filter(F.transform(F.split("_n.chapters", ";"), lambda s: number(F.trim(s))), lambda n: n.isNotNull())
    whole = F.col("_n.kind") == _NOTICES[0][0]
    each = F.explode(F.when(whole, F.array(F.lit(None).cast("int"))).otherwise(named))
    return noticed.select(*lines.columns, F.col("_n.kind").alias("change_kind"), F.col("_n.year").alias("session_year"), each.alias("session_law_chapter"))


_REFERENCE = find_spans_udf(rf"({NUMBER})\s+to\s+({NUMBER})|({NUMBER})|(?i:(?<=\bORS)\s+(chapter\s+(\d{{1,3}}[A-Z]?)\b))")


def references(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """Cross-references in reading order: kind (range, section, chapter), text, start, end, numbers, context.

    One alternation with the range first hides a range's ends from the section kind.
    """
    spans = df.select(*keys, F.col(text).alias("_t"), F.posexplode(_REFERENCE(F.col(text))).alias("ordinal", "s"))
    g = lambda i: F.get("s.groups", F.lit(i))
    kind = F.when(g(0).isNotNull(), "range").when(g(2).isNotNull(), "section").otherwise("chapter")
    shown = F.when(kind == "chapter", g(3)).otherwise(F.col("s.match"))
    start = F.col("s.end") - F.length(shown)
    return spans.select(
        *keys, "ordinal", kind.alias("kind"), shown.alias("text"), start.alias("start"), F.col("s.end").alias("end"),
        F.coalesce(g(0), g(2)).alias("first"), g(1).alias("last"), g(4).alias("chapter"), context(F.col("_t"), start, F.col("s.end")).alias("context"),
    )


def resolved(refs: DataFrame, sections: DataFrame) -> DataFrame:
    """One row per cited number, a range citing two, with section_id or null (J9, W5). sections(number, section_id)."""
    ends = F.when(F.col("kind") == "range", F.array("first", "last")).when(F.col("kind") == "section", F.array("first")).otherwise(F.array(F.lit(None).cast("string")))
    cited = refs.select("*", F.posexplode(ends).alias("endpoint", "number"))
    return cited.join(sections, "number", "left")


#: What joins a defined term to its wording, longest first (fixed values); all but the first stay in the wording.
_VERBS = ("means", "does not include", "does not mean", "includes", "has", "is")
_QUOTES = "[“”\"']"


def definitions(df: DataFrame, text: str, citation: str) -> DataFrame:
    """(citation, defined_term, definition_text) of texts that open a definitions block.

    Entries are cut at their numbers; an entry is cut at its quotes, which leaves its term, an alias where only "or" stands
    between two terms, and the wording behind them, which is cut at its first verb or colon.
    """
    t = F.col(text)
    opens = t.rlike("(?i)As used in[^\\n:]{0,200}:") | F.lower(F.ltrim(t)).startswith("definitions")
    numbered = f"\\(\\s*\\d+\\s*\\)(\\([a-z]\\))?\\s*{_QUOTES}"
    entries = df.filter(opens).select(F.col(citation).alias("citation"), F.posexplode(F.split(t, f"(?={numbered})")).alias("entry", "p")).filter(F.col("p").rlike(f"^{numbered}"))
    cut = lambda c: F.split(c, _QUOTES, 3)
    once = entries.withColumn("one", cut(F.col("p"))).withColumn("two", cut(F.get("one", F.lit(2))))
    alias = (F.lower(F.trim(F.get("two", F.lit(0)))) == "or") & (F.size("two") == 3)
    tail = F.when(alias, F.get("two", F.lit(2))).otherwise(F.get("one", F.lit(2)))
    either = "|".join(v.replace(" ", "\\s+") for v in _VERBS)
    joint = f"^[^“”\"'\\n]{{0,150}}?(?:\\b({either})[,:\\s]+|:\\s*)"
    squeezed = lambda c: F.trim(F.regexp_replace(c, "(?U)\\s+", " "))
    read = once.select("citation", "entry", F.array(F.get("one", F.lit(1)), F.when(alias, F.get("two", F.lit(1)))).alias("terms"), tail.alias("tail")).filter(F.col("tail").rlike(f"(?i){joint}"))
    verb = F.lower(squeezed(F.regexp_extract("tail", f"(?i){joint}", 1)))
    body = F.regexp_replace(squeezed(F.regexp_replace("tail", f"(?i){joint}", "")), "\\.+$", "")
    wording = F.concat(F.when(verb.isin("", _VERBS[0]), F.lit("")).otherwise(F.concat(verb, F.lit(" "))), body, F.lit("."))
    both = read.select("citation", "entry", F.posexplode("terms").alias("alias", "term"), wording.alias("definition_text"), body.alias("body"))
    named = both.withColumn("defined_term", squeezed(F.col("term"))).filter("defined_term <> '' and length(term) <= 160 and body <> ''")
    return named.select("citation", "defined_term", "definition_text")


def stub_kind(text: Column) -> Column:
    """Struct status and renumbered_to of a section that is only a stub: repealed, renumbered, reserved or a note (E5)."""
    to = F.nullif(F.regexp_extract(text, f"(?i)\\brenumbered\\s+({NUMBER})", 1), F.lit(""))
    status = F.when(text.rlike("(?i)\\brepealed\\b"), "repealed").when(text.rlike("(?i)\\brenumbered\\b"), "renumbered").when(text.rlike("(?i)\\breserved\\b"), "reserved").otherwise("note_only")
    return F.struct(status.alias("status"), F.when(status == "renumbered", to).alias("renumbered_to"))


def effective_date(text: Column) -> Column:
    """Struct found and date: the explicitly stated effective date; found without a date is a diagnostic."""
    value = F.regexp_replace(F.regexp_extract(text, _DATE, 1), "\\s+", " ")
    date = F.coalesce(F.try_to_timestamp(value, F.lit("MMMM d, yyyy")), F.try_to_timestamp(value, F.lit("yyyy-MM-dd"))).cast("date")
    return F.struct(text.rlike(_DATE).alias("found"), F.when(text.rlike(_DATE), date).alias("date"))


def edition_year(text: Column) -> Column:
    """The one printed edition year, or null where there is none or more than one."""
    own, after = f"(?im)^[ \\t]*({YEAR})\\s+(?:ORS\\s+)?EDITION[ \\t]*$", f"(?im)^[ \\t]*(?:ORS\\s+)?EDITION\\s*[:\\-]?\\s*({YEAR})[ \\t]*$"
    years = F.array_distinct(F.concat(F.regexp_extract_all(text, F.lit(own), F.lit(1)), F.regexp_extract_all(text, F.lit(after), F.lit(1))))
    return F.when(F.size(years) == 1, F.get(years, F.lit(0)).cast("int"))


def is_subdivision_heading(line: Column) -> Column:
    """Upper-case headings between sections."""
    letters = F.regexp_replace(line, "[^A-Za-z]", "")
    return (F.length(letters) >= 3) & (F.upper(line) == line) & ~line.rlike(f"^\\s*{NUMBER}")


#: Mentions of a repeal that repeal nothing: how the text opens, and what it also says (fixed values).
_INCIDENTAL = (
    ("Notwithstanding the transfer of duties, functions and powers", ("continue in effect until superseded or repealed by rules",)),
    ("If any provision of section", ("does not affect the validity of any action",)),
    ("(1) On or before", ("shall report to the Governor", "if section", "are not repealed on")),
)


def triage(reason: Column, text: Column) -> Column:
    """Struct category and disposition of a diagnostic (E31): the first category whose test holds.

    An order is what stands before "amended to read:", without a leading condition or number. Its first words tell a
    provision of a session law: "Section 3 ..." without sections of the code, or a heading and then such a section.
    """
    t = F.trim(F.regexp_replace(text, "(?U)\\s+", " "))
    incidental = F.lit(False)
    for opening, phrases in _INCIDENTAL:
        holds = t.startswith(opening)
        for phrase in phrases:
            holds &= F.contains(t, F.lit(phrase))
        incidental |= holds
    order = F.split_part(t, F.lit("amended to read:"), F.lit(1))
    guarded = order.startswith("If House Bill ") | order.startswith("If Senate Bill ")
    order = F.ltrim(F.when(guarded & F.contains(order, F.lit(" becomes law,")), F.substring(order, F.locate(" becomes law,", order) + 13, F.length(order))).otherwise(order))
    order = F.regexp_replace(order, "^(Repeals\\. ?)?(\\([0-9]+\\) ?)?", "")
    words = F.split(order, " ")
    numbered = lambda c: F.substring(c, 1, 1).between("0", "9")
    code_too = F.exists(F.slice(F.split(order, "and ORS "), 2, F.greatest(F.size(F.split(order, "and ORS ")) - 1, F.lit(1))), numbered)
    direct = F.lower(F.get(words, F.lit(0))).isin("section", "sections") & numbered(F.get(words, F.lit(1))) & ~code_too
    headed = F.split_part(F.substring(order, F.locate(". Section ", order) + 10, F.length(order)), F.lit("."), F.lit(1))
    of_act = (F.locate(". Section ", order) > 1) & numbered(headed) & headed.like("%, chapter _%, Oregon Laws %")
    category = F.when(reason == "existing ORS series membership", "series_membership").when(incidental, "incidental_repeal_reference").when(direct | of_act, "session_law_provision").otherwise("unresolved")
    return F.struct(category.alias("category"), F.when(category == "unresolved", "review_required").otherwise("expected_scope").alias("disposition"))


_STARTS = find_spans_udf(_BRACKET.replace("\\\\", "\\"), 2)


def bracket_end(text: Column, start: Column) -> Column:
    """End of the bracket that opens at ``start``, nested ones included; null if it stays open.

    Depth is a fold over the brackets behind ``start`` only.
    """
    rest = F.substring(text, start + 1, F.length(text))
    marks = F.regexp_extract_all(rest, F.lit("([^\\[\\]]*[\\[\\]])"), F.lit(1))
    zero = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(-1).alias("end"))

    def step(s: Column, m: Column) -> Column:
        at = s["at"] + F.length(m)
        depth = s["depth"] + F.when(m.endswith("["), 1).otherwise(-1)
        return F.struct(depth.alias("depth"), at.alias("at"), F.when((s["end"] < 0) & (depth == 0), at).otherwise(s["end"]).alias("end"))

    end = F.aggregate(marks, zero, step, lambda s: s["end"])
    return F.when(end >= 0, start + end)


def bracket_notes(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """Bracketed statutory notes: keys, note_text, start, end; a null end tells of a bracket left open."""
    starts = df.select(*keys, F.col(text).alias("_t"), F.explode(_STARTS(F.col(text))).alias("s"))
    ended = starts.withColumn("end", bracket_end(F.col("_t"), F.col("s.start"))).withColumn("start", F.col("s.start"))
    before = Window.partitionBy(*keys).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    outer = ended.withColumn("_open", F.coalesce(F.max("end").over(before), F.lit(0))).filter(F.col("start") >= F.col("_open"))
    return outer.select(*keys, F.substring(F.col("_t"), F.col("start") + 1, F.coalesce(F.col("end"), F.length("_t")) - F.col("start")).alias("note_text"), "start", "end")


_MEASURE = "(?i)(?:HB|SB)\\s+\\d+|\\d{4}\\s+c\\.\\s*\\d+(?:\\s+§\\s*\\w+)?|(?:sections?\\s+[\\d\\w, and]+,\\s*)?chapter\\s+\\d+,\\s*Oregon Laws\\s+\\d{4}"


def enacting_measure(note: Column) -> Column:
    """The measure that a note names first, or null."""
    return F.nullif(F.regexp_extract(note, _MEASURE, 0), F.lit(""))


def tells_of_change(kind: Column, note: Column) -> Column:
    """Whether a note, not being a source credit, speaks of a pending change."""
    return (kind != "source_credit") & note.rlike("(?i)amend|repeal|effective|takes effect|not added to ORS|becomes operative")


def pending_changes(notes: DataFrame) -> DataFrame:
    """notes(edition_year, chapter_number, section, ordinal, kind, note_text) -> pending-change rows with ids.

    A date that is worded but impossible stays null and sets bad_date.
    """
    from lexloom.functions.keys import stable_id

    date = effective_date(F.col("note_text"))
    rows = notes.filter(tells_of_change(F.col("kind"), F.col("note_text"))).withColumn("_d", date)
    key = stable_id(F.col("edition_year"), F.col("chapter_number"), F.col("section"), F.col("ordinal"), F.col("note_text"))
    return rows.select(
        key.alias("id"), F.col("section").alias("target_section"), enacting_measure(F.col("note_text")).alias("enacting_measure"),
        F.col("_d.date").alias("effective_date"), "note_text", (F.col("_d.found") & F.col("_d.date").isNull()).alias("bad_date"),
    )


def note_candidates(text: Column, reach: int = 200) -> Column:
    """Array of struct introducer and context of the notes that a text may open."""
    found = F.regexp_extract_all(text, F.lit(f"(?s)\\bNotes?:\\s.{{0,{reach}}}"), F.lit(0))
    return F.transform(found, lambda f: F.struct(F.regexp_extract(f, "^Notes?:", 0).alias("introducer"), f.alias("context")))


def stub_contexts(df: DataFrame, markup: str, text: str, anchored: str, keys: list[str], reach: int = 150, limit: int = 10) -> DataFrame:
    """keys, number, raw_markup: markup around numbers that a bracket follows and no anchor (array column) has."""
    numbers = F.array_except(F.array_distinct(F.regexp_extract_all(text, F.lit(f"({NUMBER})\\s*\\["), F.lit(1))), F.col(anchored))
    each = df.select(*keys, F.col(markup).alias("_m"), F.posexplode(F.slice(numbers, 1, limit)).alias("ordinal", "number"))
    at = F.expr("instr(_m, number)")
    return each.withColumn("_at", at).filter("_at > 0").select(*keys, "number", F.expr(f"substring(_m, greatest(1, _at - {reach}), {reach} + least(_at - 1, {reach}))").alias("raw_markup"))
