"""Identifiers, citations and sort keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A section number: up to three digits, an optional letter, three or four decimals.
SECTION = "[1-9]\\d{0,2}[A-Z]?\\.\\d{3,4}"
_CHAPTER = "^0*(\\d+)([A-Za-z]?)$"


def stable_id(*parts: Column) -> Column:
    """SHA-256 of the parts joined by colons; a null part reads None."""
    return F.sha2(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts]), 256)


def public_id(edition: Column, section: Column, version: Column | None = None, prefix: str = "ors") -> Column:
    """prefix:edition:section, with :vN for a printed version."""
    parts = [F.lit(prefix), edition.cast("string"), section]
    return F.concat_ws(":", *parts, *([F.concat(F.lit("v"), version.cast("string"))] if version is not None else []))


def citation(text: Column) -> Column:
    """A citation's section number, upper case; null where the text is none."""
    found = F.regexp_extract(F.upper(F.trim(text)), f"^(?:ORS\\s+)?({SECTION})$", 1)
    return F.nullif(found, F.lit(""))


def chapter_number(text: Column) -> Column:
    """Without leading zeros, letter in upper case; null where it is none."""
    t = F.trim(text)
    return F.when(t.rlike(_CHAPTER), F.concat(F.regexp_extract(t, _CHAPTER, 1), F.upper(F.regexp_extract(t, _CHAPTER, 2))))


def chapter_digits(text: Column) -> Column:
    """The number of a chapter without its letter (M7)."""
    return F.try_cast(F.regexp_extract(chapter_number(text), "^(\\d+)", 1), "int") if hasattr(F, "try_cast") else F.regexp_extract(chapter_number(text), "^(\\d+)", 1).try_cast("int")


def chapter_sort_key(text: Column) -> Column:
    """Six digits and the letter or a space; what is no chapter sorts last."""
    number = F.lpad(F.regexp_extract(F.trim(text), _CHAPTER, 1), 6, "0")
    letter = F.upper(F.regexp_extract(F.trim(text), _CHAPTER, 2))
    key = F.concat(number, F.when(letter == "", F.lit(" ")).otherwise(letter))
    return F.when(F.trim(text).rlike(_CHAPTER), key).otherwise(F.lit("999999~"))


def section_sort_key(section: Column) -> Column:
    """The chapter's sort key, a period and the decimals."""
    return F.concat(chapter_sort_key(F.split_part(section, F.lit("."), F.lit(1))), F.lit("."), F.split_part(section, F.lit("."), F.lit(2)))


def chapter_stem(text: Column, prefix: str = "ors") -> Column:
    """A chapter's file name stem."""
    number = chapter_number(text)
    return F.concat(F.lit(prefix), F.lpad(F.regexp_extract(number, "^(\\d+)", 1), 3, "0"), F.lower(F.regexp_extract(number, "([A-Z]?)$", 1)))


def chapter_url(text: Column, template: str) -> Column:
    """A chapter's address from a template that has one %s for the stem."""
    return F.format_string(template, chapter_stem(text))


def volume_id(edition: Column, volume: Column) -> Column:
    """edition-vNN; null for a null volume."""
    return F.when(volume.isNotNull(), F.concat(edition.cast("string"), F.lit("-v"), F.lpad(volume.cast("string"), 2, "0")))


def title_id(edition: Column, title: Column) -> Column:
    """edition-tN; null for a null title."""
    return F.when(title.isNotNull(), F.concat(edition.cast("string"), F.lit("-t"), title.cast("string")))


def child_id(parent: Column, letter: str, ordinal: Column, width: int) -> Column:
    """parent-<letter><zero-padded ordinal>."""
    return F.concat(parent, F.lit(f"-{letter}"), F.lpad(ordinal.cast("string"), width, "0"))


def chapter_range(text: Column) -> Column:
    """Struct first, last, first_key, last_key of 'N', 'N-M' or 'N to M' (S30)."""
    pattern = "^\\s*(\\d+[A-Za-z]?)(?:\\s*(?:-|–|to)\\s*(\\d+[A-Za-z]?))?\\s*$"
    first = F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    last = F.coalesce(F.nullif(F.regexp_extract(text, pattern, 2), F.lit("")), first)
    return F.struct(chapter_number(first).alias("first"), chapter_number(last).alias("last"), chapter_sort_key(first).alias("first_key"), chapter_sort_key(last).alias("last_key"))


def section_numbers(text: Column) -> Column:
    """Distinct section numbers of a text, ascending."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit("\\d{1,3}[A-Z]?\\.\\d{3,4}"), F.lit(0))))


def row_digest(*columns: str) -> Column:
    """SHA-256 of a row as JSON with its keys in order and nulls kept."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)
