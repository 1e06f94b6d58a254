"""Safe casts from dirty text, exact rounding, guarded division, formatting."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import map_of
from ledgerloom.reference_data import FALSE_WORDS, STRIP_CHARS, TRUE_WORDS

# Strftime codes and their Spark pattern letters.
STRFTIME_CODES = {
    "%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%y": "yy",
    "%b": "MMM", "%B": "MMMM", "%f": "SSSSSS", "%p": "a", "%I": "hh", "%j": "DDD",
}

# Date layouts read without a format: year first (one separator, or eight digits), and month/day/year.
YEAR_FIRST = r"^(\d{4})(?:([-/.])(\d{1,2})\2(\d{1,2})|(\d{2})(\d{2}))(?=$|[ T])"
YEAR_LAST = r"^(\d{1,2})/(\d{1,2})/(\d{4})(?=$|[ T])"
ISO_START = r"^(\d{4}-\d{1,2}-\d{1,2}(?:[ T].*)?)$"


def iso_text(col: Column) -> Column:
    """Text that starts with a date, in ISO form, else empty text. Casting it needs no parser and throws
    nothing. Each step uses its input once, so the generated code stays small."""
    year_first = F.regexp_replace(F.trim(col.cast("string")), YEAR_FIRST, "$1-$3$5-$4$6")
    return F.regexp_extract(F.regexp_replace(year_first, YEAR_LAST, "$3-$1-$2"), ISO_START, 1)


def by_format(col: Column, fmt: str) -> Column:
    """Time stamp by one format. Text of another shape is sorted out before it is parsed."""
    pattern, text = spark_pattern(fmt), F.trim(col.cast("string"))
    parsed = F.try_to_timestamp(text, F.lit(pattern))
    if re.search(r"M{3,}|[aDS]|'", pattern):
        return parsed
    plain = re.sub(r"([.()\[\]])", r"\\\1", pattern)
    shape = re.sub(r"[A-Za-z]+", lambda m: rf"\d{{1,{max(2, len(m.group(0)))}}}", plain)
    return F.when(text.rlike(f"^{shape}$"), parsed)


def spark_pattern(fmt: str) -> str:
    """Translate a strftime format; text without ``%`` is taken as a Spark pattern."""
    if "%" not in fmt:
        return fmt
    return re.sub(r"%[A-Za-z]", lambda m: STRFTIME_CODES[m.group(0)], fmt)


def strip_chars(col: Column, chars: list[str] | None = None) -> Column:
    """Remove every listed character in one pass."""
    return F.translate(col, "".join(STRIP_CHARS if chars is None else chars), "")


def has_any_char(col: Column, chars: list[str] | None = None) -> Column:
    """True where at least one listed character occurs."""
    return F.coalesce(strip_chars(col, chars) != col, F.lit(False))


def to_integer(col: Column) -> Column:
    """Whole number from dirty text; a fraction is cut off, what cannot be read is NULL.

    Marks for a missing value (blank, ``-``, ``N/A``, ``nan``, ``None``) are no numbers, so they need no list.
    """
    return strip_chars(col.cast("string"), [",", "$", "元"]).try_cast("decimal(38,18)").try_cast("bigint")


def to_number(col: Column, dtype: str = "double") -> Column:
    """Number from dirty text; a trailing percent sign divides by 100."""
    text = col.cast("string")
    number = strip_chars(text, [",", "$", "%"]).try_cast(dtype)
    if dtype in ("double", "float"):
        number = F.nanvl(number, F.lit(None).cast(dtype))
    scale = F.when(F.rtrim(text).endswith("%"), F.lit(100)).otherwise(F.lit(1))
    return (number / scale).cast(dtype)


def _by_formats(col: Column, fmt: str | list[str]) -> Column:
    """The first of several formats that a text has."""
    return F.coalesce(*[by_format(col, f) for f in ([fmt] if isinstance(fmt, str) else fmt)])


def to_date(col: Column, fmt: str | list[str] | None = None) -> Column:
    """Date from text by one format, by the first of several that it has, or in any of the usual layouts."""
    return _by_formats(col, fmt).cast("date") if fmt else iso_text(col).try_cast("date")


def to_timestamp(col: Column, fmt: str | list[str] | None = None) -> Column:
    """Time stamp from text by one format, by the first of several that it has, or in any of the usual layouts."""
    return _by_formats(col, fmt) if fmt else iso_text(col).try_cast("timestamp")


def to_boolean(col: Column) -> Column:
    word = F.lower(F.trim(col.cast("string")))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def cut(col: Column) -> Column:
    """Whole part of an exact amount, toward zero."""
    return col.cast("bigint")


def half_even(col: Column, places: int = 0) -> Column:
    """Banker's rounding, exact on decimals."""
    return F.bround(col, places)


def ratio(numerator: Column, denominator: Column, default=None) -> Column:
    """Division that yields ``default`` where the denominator is zero or missing."""
    value = F.try_divide(numerator, denominator)
    return value if default is None else F.coalesce(value, F.lit(default).cast("double"))


def grouped_digits(col: Column, places: int = 0) -> Column:
    """Thousands separators; a missing amount reads ``N/A``."""
    return F.coalesce(F.format_number(col, places), F.lit("N/A"))


def recode(col: Column, mapping: dict, default=None, keep: bool = True) -> Column:
    """Replace known values; others stay, or take ``default`` when ``keep`` is off."""
    rest = col if keep else F.lit(default)
    return F.coalesce(F.try_element_at(F.expr(map_of(mapping)), col), rest) if mapping else rest


def known_or(col: Column, known: list, default) -> Column:
    """Keep listed values, map everything else, NULL included, to ``default``."""
    return F.when(col.isin(*known), col).otherwise(F.lit(default))
