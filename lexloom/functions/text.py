"""Column expressions over text: normalisation, tokens, spans and first matches. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accented Latin letters and the letters that search takes them for (fixed values).
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"
#: The space separators of Unicode (category Zs), which DuckDB's trim removes; Spark's removes U+0020 only (fixed values).
SPACES = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"


def spaces(text: Column) -> Column:
    """No-break spaces as spaces."""
    return F.replace(text, F.lit(" "), F.lit(" "))


def collapsed(text: Column) -> Column:
    """Unicode white space collapsed to single spaces, trimmed."""
    return F.trim(F.regexp_replace(text, "(?U)\\s+", " "))


def flattened(text: Column) -> Column:
    """Line breaks and tabs as spaces."""
    return F.translate(text, "\n\r\t", "   ")


def without_artifacts(text: Column) -> Column:
    """Without soft hyphens and U+0002."""
    return F.translate(text, "­\u0002", "")


def hyphens_repaired(text: Column, shared: bool = True) -> Column:
    """Words broken by a hyphen at a line's end joined again when the next line goes on in lower case.

    A line of one letter may end one break and begin the next; unless ``shared``, its letter serves the first only, as
    where SQL replaces both letters with themselves.
    """
    return F.regexp_replace(text, "(?<=[A-Za-z])-\n(?=[a-z])", "") if shared else F.regexp_replace(text, "([A-Za-z])-\n([a-z])", "$1$2")


def first_match(text: Column, pattern: str, group: int = 0) -> Column:
    """The first match, or null without one."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def first_sentence(text: Column) -> Column:
    """Up to the first period and space, without spaces around it, with one final period; empty if nothing is left."""
    head = F.trim(F.get(F.split(text, "\\. "), F.lit(0)), F.lit(SPACES))
    return F.when((head == "") | head.endswith("."), head).otherwise(F.concat(head, F.lit(".")))


def sentences(text: Column) -> Column:
    """Array of sentences, each with a final period."""
    parts = F.filter(F.split(text, "\\. "), lambda s: F.trim(s) != "")
    return F.transform(parts, lambda s: F.when(s.endswith("."), s).otherwise(F.concat(s, F.lit("."))))


def folded(text: Column) -> Column:
    """Lower case without accents, as the search index compares text."""
    return F.translate(F.lower(text), ACCENTED, PLAIN)


def search_tokens(text: Column) -> Column:
    """Letters-and-digits tokens of the folded text; everything else separates (R2)."""
    return F.regexp_extract_all(folded(text), F.lit("[\\p{L}\\p{N}]+"), F.lit(0))


def ascii_tokens(text: Column) -> Column:
    """ASCII letters-and-digits tokens in lower case (A4)."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def lexemes(text: Column) -> Column:
    """Words with inner apostrophes, or single symbols (P20)."""
    return F.regexp_extract_all(text, F.lit("(?U)\\w+(?:['’]\\w+)*|[^\\w\\s]"), F.lit(0))


def excerpt(text: Column, size: int) -> Column:
    """The first ``size`` characters."""
    return F.substring(text, 1, size)


def is_truncated(text: Column, size: int) -> Column:
    """Whether excerpt() leaves something out (P5)."""
    return F.length(text) > size


def context(text: Column, start: Column, end: Column, reach: int = 40) -> Column:
    """The span with ``reach`` characters on either side, clamped; offsets are 0-based and half-open."""
    low = F.greatest(F.lit(0), start - reach)
    return F.substring(text, low + 1, F.least(F.length(text), end + reach) - low)


def line_spans(text: Column) -> Column:
    """Array of struct line, start, end of the lines that aren't blank."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<line:string,start:int,end:int>>").alias("found"))

    def add(state: Column, line: Column) -> Column:
        item = F.struct(line.alias("line"), state["at"].alias("start"), (state["at"] + F.length(line)).alias("end"))
        found = F.when(F.trim(line) != "", F.concat(state["found"], F.array(item))).otherwise(state["found"])
        return F.struct((state["at"] + F.length(line) + 1).alias("at"), found.alias("found"))

    return F.aggregate(F.split(text, "\n"), zero, add, lambda s: s["found"])


def every_word_contained(haystack: Column, query: str) -> Column:
    """Whether each white-space-separated word of the query occurs in the lower-cased haystack."""
    words = query.lower().split()
    return F.forall(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(F.lower(haystack), w)) if words else F.lit(True)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double; 0/0 counts as 1."""
    return F.when(denominator == 0, F.lit(1.0)).otherwise(F.try_divide(numerator.cast("double"), denominator.cast("double")))


#: Words that must survive a line break for the grammar to read an act (fixed values).
CRITICAL_WORDS = (
    "amend", "amended", "amending", "amendment", "amendments", "chapter", "chapters", "effective", "providing", "provision", "provisions", "repeal", "repealed",
    "repealing", "section", "sections", "statute", "statutes",
)


def critical_words_repaired(text: Column, words: tuple[str, ...] = CRITICAL_WORDS) -> Column:
    """Line-break hyphens removed within the given words; elsewhere only the break goes and the hyphen stays."""
    inside = "|".join(f"(?<=(?<![A-Za-z])(?i:{w[:k]}))-[ \\t]*\\r?\\n[ \\t]*(?=(?i:{w[k:]})(?![A-Za-z]))" for w in words for k in range(1, len(w)))
    return F.regexp_replace(F.regexp_replace(text, inside, ""), "-[ \\t]*\\r?\\n[ \\t]*", "-")
