"""Printed glyphs to lines and texts."""

from lexloom.operators import glyphs


def test_lines_texts_and_overstrikes(spark):
    word = lambda text, x, top, font="f": [(1, c, font, x + 5.0 * i, x + 5.0 * i + 5, top) for i, c in enumerate(text)]
    rows = word("one", 10.0, 100.0) + word("one", 10.4, 100.3) + word("two", 30.0, 101.5) + word("low", 10.0, 103.0) + word("a b", 10.0, 120.0) + word("one", 10.0, 100.0, "g")
    frame = spark.createDataFrame(rows, "page int, text string, font string, x0 double, x1 double, top double")
    once = glyphs.without_overstrikes(frame, ["page"], ["text", "font"])
    assert once.count() == len(rows) - 3 and once.filter("font = 'f' and text = 'n'").first().top == 100.0
    numbered = glyphs.line_numbers(once.filter("font = 'f'"), ["page"])
    # 1.5 below the first is still its line; 3 below is not, though only 1.5 below its neighbour
    assert [(r.line, r.text) for r in glyphs.line_texts(numbered, ["page"]).orderBy("line").collect()] == [(0, "one two"), (1, "low"), (2, "a b")]
    assert glyphs.line_texts(glyphs.line_numbers(once.limit(0), ["page"]), ["page"]).count() == 0
