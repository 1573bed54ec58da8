"""Rosters: volumes, titles and chapters from a printed table, and what they cover.

The table is read by windows over its numbered lines: a title whose name wraps is held open by the line after it, so
one look ahead decides each line, and the running volume is the last one announced before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions import keys
from lexloom.functions.text import collapsed

#: Wordings of the printed table (fixed values).
_RANGE = "[0-9A-Za-z]+(?:\\s*[-–—]\\s*[0-9A-Za-z]+)?"
_VOLUME = "(?i)^Volume\\s+(\\d{1,2})\\b"
_TITLE = f"^(?:Title\\s+)?(\\d{{1,3}}[A-Z]?)\\s+(\\S.*?)\\s*[–—]\\s*Chs?\\.\\s*({_RANGE})\\s*$"
_HEAD = "^(?:Title\\s+)?(\\d{1,3}[A-Z]?)\\s+(\\S.*?)\\s*$"
_TAIL = f"^(\\S.*?)\\s*[–—]\\s*Chs?\\.\\s*({_RANGE})\\s*$"
_ONLY = f"^Chs?\\.\\s*({_RANGE})\\s*$"
_HEADING = "(?i)^(?:ORS\\s+)?Chapter\\s+(\\d{1,3}[A-Z]?)\\s*(?:[-–—.:]\\s*)?(.*)$"


def titles(lines: DataFrame, document: list[str], line: str = "line", at: str = "n") -> DataFrame:
    """Numbered lines -> document, kind (title, unparsed, unresolved), number, name, volume, first, last and their keys.

    A line that opens a title without its range joins the next line if that one completes it; one that is never
    completed is unresolved, never lost. The first entry of a number stands.
    """
    order = Window.partitionBy(*document).orderBy(at)
    rows = lines.select(*document, at, collapsed(F.col(line)).alias("line")).filter("line <> ''")
    volume = F.when(F.col("line").rlike(_VOLUME), F.regexp_extract("line", _VOLUME, 1).cast("int"))
    rows = rows.withColumn("volume", F.last(volume, ignorenulls=True).over(order)).withColumn("next", F.lead("line").over(order))
    whole, is_volume = F.col("line").rlike(_TITLE), F.col("line").rlike(_VOLUME)
    opens = ~whole & ~is_volume & F.col("line").rlike(_HEAD)
    closes = F.coalesce(~F.col("next").rlike(_TITLE) & ~F.col("next").rlike(_VOLUME) & (F.col("next").rlike(_ONLY) | F.col("next").rlike(_TAIL)), F.lit(False))
    joined = F.when(whole, F.col("line")).when(opens & closes, F.concat(F.regexp_replace("line", "\\s*[–—]\\s*$", ""), F.when(F.col("next").rlike(_ONLY), " – ").otherwise(" "), F.col("next")))
    # a line that completes the one before it opens nothing itself
    used = F.coalesce(F.lag(opens & closes).over(order), F.lit(False))
    rows = rows.withColumn("used", used).withColumn("opens", opens).withColumn("entry", joined).filter("not used and (entry is not null or opens)")
    covers = keys.chapter_range(F.regexp_replace(F.regexp_extract("entry", _TITLE, 3), "[–—]", "-"))
    rows = rows.withColumn("covers", F.when(F.col("entry").isNotNull(), covers))
    kind = F.when(F.col("entry").isNull(), "unresolved").when(F.col("covers.first").isNull() | F.col("covers.last").isNull(), "unparsed").otherwise("title")
    number = F.upper(F.coalesce(F.regexp_extract("entry", _TITLE, 1), F.regexp_extract("line", _HEAD, 1)))
    out = rows.select(*document, at, kind.alias("kind"), number.alias("number"), F.regexp_extract("entry", _TITLE, 2).alias("name"), "volume", "covers.first", "covers.last", "covers.first_key", "covers.last_key")
    again = F.row_number().over(Window.partitionBy(*document, "number", "kind").orderBy(at))
    return out.withColumn("_again", again).filter("kind <> 'title' or _again = 1").drop("_again", at)


def volumes(found: DataFrame, document: list[str]) -> DataFrame:
    """document, volume, first and last chapter by sort key, number of titles."""
    own = found.filter("kind = 'title'").groupBy(*document, "volume")
    return own.agg(F.min_by("first", "first_key").alias("first_chapter"), F.max_by("last", "last_key").alias("last_chapter"), F.count("*").alias("n_titles"))


def covering_title(chapters: DataFrame, chapter: str, roster: DataFrame) -> DataFrame:
    """chapters with the number and volume of the first title that covers each; null for none.

    The roster is small by nature; its join is a range join that the planner broadcasts while its size allows.
    """
    keyed = chapters.withColumn("_key", keys.chapter_sort_key(F.col(chapter)))
    one = roster.filter("kind = 'title'").select(F.col("number").alias("title"), "volume", "first_key", "last_key")
    hit = keyed.select("_key").distinct().join(one, (F.col("_key") >= F.col("first_key")) & (F.col("_key") <= F.col("last_key")))
    first = hit.groupBy("_key").agg(F.min_by(F.struct("title", "volume"), "first_key").alias("_t"))
    return keyed.join(first, "_key", "left").select(*chapters.columns, "_t.title", "_t.volume")


def candidate_chapters(roster: DataFrame) -> DataFrame:
    """Chapter numbers without letters that the titles' ranges span, each once, ascending."""
    digits = lambda c: F.regexp_extract(c, "^(\\d+)", 1).cast("int")
    return roster.filter("kind = 'title'").select(F.explode(F.sequence(digits("first"), digits("last"))).alias("digits")).distinct().orderBy("digits")


def family_prefix(probes: DataFrame, family: str, place: str, present: str) -> DataFrame:
    """Of each lettered family the members before the first that is absent."""
    gap = F.min(F.when(~F.col(present), F.col(place))).over(Window.partitionBy(family))
    return probes.withColumn("_gap", gap).filter(F.col("_gap").isNull() | (F.col(place) < F.col("_gap"))).drop("_gap")


def probe_state(status: Column, error: Column) -> Column:
    """chapter, absent or failure of a probe by its HTTP status (M8)."""
    return F.when(status == 200, "chapter").when(status == 404, "absent").otherwise("failure")


def plausible_edition(text: Column) -> Column:
    """The greatest printed edition year from 1953 to 2100, or null."""
    years = F.transform(F.regexp_extract_all(text, F.lit("(?i)((?:19|20)\\d{2})\\s*EDITION"), F.lit(1)), lambda y: y.cast("int"))
    return F.array_max(F.filter(years, lambda y: y.between(1953, 2100)))


def sample_lines(text: Column, n: int = 40, width: int = 120) -> Column:
    """Bounded diagnostics: the first lines that aren't blank, cut to a width."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.trim(line) != "")
    return F.transform(F.slice(lines, 1, n), lambda line: F.substring(line, 1, width))


def chapter_heading(lines: DataFrame, document: list[str], expected: Column | None = None, head: int = 40, line: str = "line", at: str = "n") -> DataFrame:
    """document, number, name of the heading with the expected number anywhere, else the first near the top.

    ``expected`` is a column over the lines; without it only the first ``head`` lines (numbered from 0) count.
    """
    found = lines.filter(F.col(line).rlike(_HEADING)).select(
        *document, at, keys.chapter_number(F.regexp_extract(line, _HEADING, 1)).alias("number"), F.trim(F.regexp_extract(line, _HEADING, 2)).alias("name"),
        (expected if expected is not None else F.lit(None).cast("string")).alias("_want"),
    )
    rank = F.when(F.col("number") == F.col("_want"), 0).when(F.col(at) < head, 1)
    ranked = found.withColumn("_rank", rank).filter("_rank is not null")
    best = ranked.groupBy(*document).agg(F.min_by(F.struct("number", "name"), F.struct("_rank", at)).alias("_best"))
    return best.select(*document, "_best.number", "_best.name")


def unanchored_stubs(lines: DataFrame, anchored: DataFrame, document: list[str], line: str = "line") -> DataFrame:
    """Stub-shaped lines whose number no anchor has (E8). anchored(document, number)."""
    pattern = "^\\s*(\\d{1,3}[A-Z]?\\.\\d{3,4})\\s*\\[[^\\]]*\\]\\s*$"
    stubs = lines.filter(F.col(line).rlike(pattern)).withColumn("number", F.regexp_extract(line, pattern, 1))
    return stubs.join(anchored.select(*document, "number").distinct(), [*document, "number"], "left_anti").withColumn(line, F.substring(line, 1, 200))


def paragraphs(html: Column) -> Column:
    """Array of the texts of <p> elements without inner tags."""
    raw = F.regexp_extract_all(html, F.lit("(?is)<p[^>]*>(.*?)</p>"), F.lit(1))
    return F.filter(F.transform(raw, lambda p: F.trim(F.regexp_replace(F.regexp_replace(p, "<[^>]+>", ""), "\\s+", " "))), lambda p: p != "")
