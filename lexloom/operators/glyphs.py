"""Lines and text from the glyphs of a printed page, as table work: no reader of page files is needed here.

Rows are glyphs(document, page, x0, x1, top, bottom, text, ...), lengths in points. All windows run within one page, so
pages are the unit of work and nothing is ordered beyond them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions.text import collapsed


def _islands(glyphs: DataFrame, by: list[str], at: str, reach: float, name: str) -> DataFrame:
    """glyphs with ``name``: a number that rises where neighbours along ``at`` are further apart than reach."""
    along = Window.partitionBy(*by).orderBy(at)
    opens = F.coalesce((F.col(at) - F.lag(at).over(along) > reach).cast("int"), F.lit(0))
    return glyphs.withColumn("_opens", opens).withColumn(name, F.sum("_opens").over(along)).drop("_opens")


def without_overstrikes(glyphs: DataFrame, page: list[str], alike: list[str], reach: float = 1.0) -> DataFrame:
    """Glyphs without those printed again on the same spot to look bold.

    Of glyphs with equal ``alike`` columns (text, font, size) the chains of neighbours by top, and in these by x0, are
    one; its topmost, then leftmost, stays.
    """
    rows = _islands(glyphs, [*page, *alike], "top", reach, "_row")
    spots = _islands(rows, [*page, *alike, "_row"], "x0", reach, "_spot")
    first = F.row_number().over(Window.partitionBy(*page, *alike, "_row", "_spot").orderBy("top", "x0"))
    return spots.withColumn("_n", first).filter("_n = 1").drop("_n", "_row", "_spot")


def line_numbers(glyphs: DataFrame, page: list[str], reach: float = 2.0) -> DataFrame:
    """glyphs with line, from 0 down the page.

    Down the page, by tops to a tenth of a point and then x0, a glyph more than ``reach`` below the first of the
    current line opens the next. What is gathered is one page's distinct places.
    """
    place = F.struct(F.round("top", 1).alias("at"), F.col("x0"), F.col("top"))
    places = glyphs.groupBy(*page).agg(F.array_sort(F.collect_set(place)).alias("_places"))
    none = F.filter("_places", lambda p: F.lit(False))
    opened = lambda starts, p: F.when(F.size(starts) == 0, F.array(p)).when(F.abs(p["top"] - F.element_at(starts, -1)["top"]) > reach, F.concat(starts, F.array(p))).otherwise(starts)
    starts = places.select(*page, F.transform(F.aggregate("_places", none, opened), lambda p: F.struct(p["at"], p["x0"])).alias("_starts"))
    here = F.struct(F.round("top", 1).alias("at"), F.col("x0"))
    line = F.size(F.filter("_starts", lambda s: s <= here)) - 1
    return glyphs.join(starts, page).withColumn("line", line).drop("_starts")


def line_texts(glyphs: DataFrame, page: list[str], gap: float = 1.5) -> DataFrame:
    """page, line, text: a line's glyphs from left to right, with a space where more than ``gap`` points are free.

    White space is collapsed. The list that is gathered is one printed line.
    """
    across = Window.partitionBy(*page, "line").orderBy("x0", "x1")
    apart = F.coalesce(F.col("x0") - F.lag("x1").over(across) > gap, F.lit(False))
    piece = F.concat(F.when(apart, F.lit(" ")).otherwise(F.lit("")), F.col("text"))
    pieces = glyphs.withColumn("_piece", piece).groupBy(*page, "line").agg(F.array_sort(F.collect_list(F.struct("x0", "x1", "_piece"))).alias("_p"))
    return pieces.select(*page, "line", collapsed(F.array_join(F.transform("_p", lambda p: p["_piece"]), "")).alias("text"))
