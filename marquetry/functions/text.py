"""Text cleaning, tolerant casts, names, defaults and base64."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four ASCII separators that are also blank.
BLANKS = r"(?U)[\s\x1c-\x1f]+"


def collapse_spaces(c: Column) -> Column:
    """Trim, and turn each run of white space into one space."""
    return F.trim(F.regexp_replace(c, BLANKS, " "))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def differs(c: Column, tidy: Column) -> Column:
    """True where cleaning changed a value; a NULL is not a correction."""
    return F.coalesce(tidy != c, F.lit(False))


def clean_text(c: Column) -> Column:
    """``collapse_spaces``, with nothing left over read as NULL."""
    return blank_to_null(collapse_spaces(c))


def text_corrected(c: Column) -> Column:
    """True where ``collapse_spaces`` changes the text."""
    return differs(c, collapse_spaces(c))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), "[^0-9]", "")


def clean_year(c: Column, low: int = 1800, high: int = 2100) -> Column:
    """The digits of ``c`` as a year, NULL outside ``low``..``high``."""
    year = _digits(c).try_cast("int")
    return F.when(year.between(low, high), year)


def year_corrected(c: Column, low: int = 1800, high: int = 2100) -> Column:
    """True where a present year was rewritten or dropped by ``clean_year``."""
    year = clean_year(c, low, high)
    same = collapse_spaces(c.cast("string")).eqNullSafe(year.cast("string"))
    return c.isNotNull() & ~same


def tolerant_int(c: Column) -> Column:
    """Whole number, or NULL where the text is not one."""
    return c.try_cast("int")


def int_corrected(c: Column) -> Column:
    return c.isNotNull() & tolerant_int(c).isNull()


def full_name(*parts: Column) -> Column:
    return F.concat_ws(" ", *parts)


def default_to(c: Column, value) -> Column:
    """``c``, or ``value`` where the field is missing."""
    return F.coalesce(c, F.lit(value))


def as_label(c: Column) -> Column:
    """Text form of a value used as a category label."""
    return c.cast("string")


def encode_base64(c: Column) -> Column:
    """Base64 on one line; Spark's own form breaks lines at 76 characters."""
    return F.translate(F.base64(c.cast("binary")), "\r\n", "")


def decode_base64(c: Column) -> Column:
    return F.unbase64(c)


def prefix(c: Column, length: int) -> Column:
    return F.substring(c, 1, length)


def matches(c: Column, pattern: str) -> Column:
    """Case-insensitive regular expression search."""
    return c.rlike(f"(?iu){pattern}")


def contains_any(term: str, *columns: Column) -> Column:
    """Case-insensitive substring in any of the columns."""
    needle = F.lit(term.lower())
    found = F.lit(False)
    for c in columns:
        found = found | F.coalesce(F.contains(F.lower(c), needle), F.lit(False))
    return found
