"""String helpers whose results equal those of Python's string methods."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: Unicode white space, as str.strip() and str.split() see it.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: The same for the inside of a character class.  Java's own Unicode classes are slow, and so
#: are ranges: single characters up to U+00FF are looked up in one table, and all others but
#: those between the first and the last are told apart by one comparison.
SPACE = r"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
#: Fixed value: where str.splitlines() ends a line.
BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def let(x: Column, make: Callable[[Column], Column]) -> Column:
    """``make(x)`` with ``x`` worked out once, however often ``make`` names it: an expression
    that is named twice would be copied, and copies in copies grow without bound."""
    return F.get(F.transform(F.array(x), make), F.lit(0))


def strip(x: Column) -> Column:
    return F.btrim(x, F.lit(SPACES))


def blank_to_null(x: Column) -> Column:
    """Null, empty and blank all count as missing."""
    return F.when(x.rlike(rf"[^{SPACE}]"), x)


def lines(x: Column) -> Column:
    """The lines of a text; a last line end adds none."""
    return let(F.split(x, BREAK), lambda xs: F.when(F.element_at(xs, -1) == "", F.slice(xs, F.lit(1), F.size(xs) - 1)).otherwise(xs))


def stripped_lines(x: Column) -> Column:
    """The lines of a text that aren't blank, without the space around them."""
    return F.filter(F.transform(F.split(x, BREAK), strip), lambda line: line != "")


def word_count(x: Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(x, F.lit(rf"[^{SPACE}]+"), F.lit(0))), F.lit(0))


def text_key(x: Column) -> Column:
    """Lower case, single spaces, none around; null if nothing is left."""
    return F.nullif(F.regexp_replace(F.lower(strip(x)), rf"[{SPACE}]+", " "), F.lit(""))


def string_list(x: Column) -> Column:
    """The parts between ``;`` and ``,`` that aren't blank; none for null.  A text of
    nothing but separators is its own single part."""
    parts = F.filter(F.transform(F.split(x, "[;,]"), strip), lambda part: part != "")
    whole = F.filter(F.array(strip(x)), lambda part: part != "")
    return F.when(x.isNull(), F.array().cast("array<string>")).when(x.rlike(f"[^;,{SPACE}]"), parts).otherwise(whole)


def clean_list(xs: Column) -> Column:
    """T3 for a list: its parts that aren't blank."""
    return F.coalesce(F.filter(F.transform(xs, strip), lambda x: x.isNotNull() & (x != "")), F.array().cast("array<string>"))


def stamp(time: Column) -> Column:
    """A time as it goes into file names."""
    return F.date_format(time, "yyyyMMdd_HHmmss")


def iso_time(time: Column) -> Column:
    """A time in ISO 8601 with microseconds, as logs have it."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
