"""Tolerant column cleaning for files whose every field arrives as text.

ANSI mode raises on a bad cast, so each coercion here uses a ``try_`` form: a value that
cannot be read becomes NULL and stays visible to the validation step.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spellings of a date.  Fixed values.
DAY_FIRST_SHAPE = r"^(\d{1,2})([/. -])(\d{1,2})\2(\d{4}|\d{2})$"
YEAR_FIRST_SHAPE = r"^(\d{4})([/. -])(\d{1,2})\2(\d{1,2})$"
DAY_MONTH_NAME_SHAPE = r"^(\d{1,2})(?:st|nd|rd|th)?[/. ,-]*([a-z]{3,9})[/. ,-]*(\d{4}|\d{2})$"
MONTH_NAME_DAY_SHAPE = r"^([a-z]{3,9})[/. ,-]*(\d{1,2})(?:st|nd|rd|th)?[ ,]+(\d{4}|\d{2})$"
#: A time of day behind a date.  Fixed value.
TIME_SHAPE = (r"(?i)(t|\s+)\d{1,2}:\d{2}(:\d{2}([.,]\d+)?)?\s*([ap]m)?"
              r"\s*(z|utc|[+-]\d{2}:?\d{2})?$")
MONTH_NAMES = ("january", "february", "march", "april", "may", "june", "july", "august",
               "september", "october", "november", "december")
#: Two-digit years up to this one are 20xx, later ones 19xx.  Fixed value.
LAST_SHORT_YEAR = 68
#: Plain or scientific decimal number.  Fixed value.
NUMBER_SHAPE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

#: Byte-order mark as read in UTF-8 and as mis-read in Latin-1.  Fixed values.
BYTE_ORDER_MARKS = ("\ufeff", "\u00ef\u00bb\u00bf")


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- headers ------------------------------------------------------------------------------


def _without_mark(name: str) -> str:
    for mark in BYTE_ORDER_MARKS:
        name = name.removeprefix(mark)
    return name


def squeeze_header(name: str) -> str:
    """Trim, lower-case and collapse inner white space (line breaks included)."""
    return re.sub(r"\s+", " ", _without_mark(name)).strip().lower()


def snake_header(name: str) -> str:
    """:func:`squeeze_header`, then every run of other characters becomes one underscore."""
    return re.sub(r"[^0-9a-z]+", "_", squeeze_header(name)).strip("_")


def one_line_header(name: str) -> str:
    """Only collapse white space; keep the letter case."""
    return re.sub(r"\s+", " ", _without_mark(name)).strip()


def normalise_headers(df: DataFrame, rule=squeeze_header) -> DataFrame:
    return df.toDF(*[rule(name) for name in df.columns])


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename after headers were normalised, so a stray space cannot hide a column."""
    return df.withColumnsRenamed(names)


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


# --- text ---------------------------------------------------------------------------------


def canonical(value: str | Column) -> Column:
    """Join key form of a name or e-mail address."""
    return F.lower(F.trim(_col(value)))


def code(value: str | Column) -> Column:
    return F.upper(F.trim(_col(value)))


def filled(value: str | Column) -> Column:
    return F.coalesce(_col(value), F.lit(""))


def null_if_token(value: str | Column, tokens: Iterable[str] = ("nan", "")) -> Column:
    """Canonical text with the stand-ins for "no value" turned into NULL."""
    text = canonical(value)
    return F.when(~text.isin(list(tokens)), text)


def pipe_separated(value: str | Column) -> Column:
    """Id list that survives a comma-separated file."""
    return F.regexp_replace(_col(value), ",", " |")


# --- numbers, dates, flags ----------------------------------------------------------------


def number(value: str | Column) -> Column:
    """Finite double with thousands commas removed; words such as ``nan`` and ``inf``, type
    suffixes and numbers beyond a double are NULL."""
    text = F.regexp_replace(F.trim(_col(value)), ",", "")
    parsed = F.when(text.rlike(NUMBER_SHAPE), text).try_cast("double")
    return F.when(F.abs(parsed) < F.lit(float("inf")), parsed)


def whole(value: str | Column) -> Column:
    """Whole part of a number as a 64-bit integer; 0 if missing, NULL if it does not fit."""
    return F.coalesce(_col(value), F.lit(0)).try_cast("bigint")


def digits(value: str | Column) -> Column:
    """Whole-number key; anything but plain digits is NULL."""
    text = F.trim(_col(value))
    return F.when(text.rlike("^[0-9]+$"), text).try_cast("bigint")


def positive_int(value: str | Column) -> Column:
    """Whole number above zero, else NULL."""
    text = F.trim(_col(value))
    parsed = F.when(text.rlike("^[+-]?[0-9]+$"), text).try_cast("int")
    return F.when(parsed > 0, parsed)


def _full_year(year: Column) -> Column:
    century = F.when(year.try_cast("int") <= LAST_SHORT_YEAR, "20").otherwise("19")
    return F.when(F.length(year) == 2, F.concat(century, year)).otherwise(year)


def _month_number(name: Column) -> Column:
    """Number of a month given by its name or at least its first three letters."""
    found = F.lit(None).cast("string")
    for number_, month in enumerate(MONTH_NAMES, 1):
        found = F.when(F.startswith(F.lit(month), name), str(number_)).otherwise(found)
    return found


def day_first_date(value: str | Column) -> Column:
    """Date written day first, year first or with the month's name, with a two- or four-digit
    year, with or without a time of day; an impossible day is NULL.

    Rewritten to ISO and cast: the cast reads digits itself, while a format parser throws for
    every row written in another spelling.
    """
    text = F.regexp_replace(F.lower(F.trim(_col(value))), TIME_SHAPE, "")
    # a lambda keeps the many shapes out of the generated code of wide files; no date is shorter
    return F.when(F.length(text) >= 6, F.transform(F.array(text), _read_day)[0])


def _read_day(text: Column) -> Column:
    def part(shape: str, group: int) -> Column:
        return F.regexp_extract(text, shape, group)

    def iso(shape: str, year: int, month: Column, day: int) -> Column:
        dash = F.lit("-")
        return F.concat(
            _full_year(part(shape, year)), dash, month, dash, part(shape, day)).try_cast("date")

    return (
        F.when(text.rlike(DAY_FIRST_SHAPE),
               iso(DAY_FIRST_SHAPE, 4, part(DAY_FIRST_SHAPE, 3), 1))
        .when(text.rlike(YEAR_FIRST_SHAPE),
              iso(YEAR_FIRST_SHAPE, 1, part(YEAR_FIRST_SHAPE, 3), 4))
        .when(text.rlike(DAY_MONTH_NAME_SHAPE),
              iso(DAY_MONTH_NAME_SHAPE, 3, _month_number(part(DAY_MONTH_NAME_SHAPE, 2)), 1))
        .when(text.rlike(MONTH_NAME_DAY_SHAPE),
              iso(MONTH_NAME_DAY_SHAPE, 3, _month_number(part(MONTH_NAME_DAY_SHAPE, 1)), 2))
    )


def yes_no(value: str | Column) -> Column:
    text = canonical(value)
    return F.when(text == "yes", F.lit(True)).when(text == "no", F.lit(False))


def percent(part: str | Column, whole: str | Column) -> Column:
    """Share in percent; a zero or missing whole gives NULL."""
    return F.try_divide(_col(part), _col(whole)) * 100


def half_even_int(value: str | Column) -> Column:
    """Nearest whole number, ties to even, as the reports round call lengths."""
    return F.rint(_col(value)).cast("int")


def mapped(value: str | Column, names: dict[str, int]) -> Column:
    """Look up a short fixed dictionary; unknown keys give NULL."""
    pairs = [F.lit(part) for item in names.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), _col(value))
