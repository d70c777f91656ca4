"""Text to typed values. Whatever does not fit becomes NULL, with ANSI mode on or off.

Dates and timestamps are recognised by shape and put in ISO order first, so one native cast does
the parsing; chained format parsers would throw and catch an exception per miss and per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted shapes, and the marks that census tables use for "no value".
ISO_DATE_20XX = r"^20\d{2}-\d{2}-\d{2}"
SLASH_DATE_20XX = r"^\d{2}/\d{2}/20\d{2}"
ISO_MOMENT = r"^\d{4}-\d{2}-\d{2}( \d{2}:\d{2}:\d{2})?$"
SLASH_MOMENT = r"^\d{2}/\d{2}/\d{4}( \d{2}:\d{2}:\d{2})?$"
DIGITS = r"^(\d+)$"
CLOCK_PREFIX = r"^(\d{2}:\d{2}:\d{2})"
CLOCK = r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d$"
COORDINATE = r"^(-?\d+(\.\d+)?)$"
WHOLE_PART = r"^\s*([+-]?\d+)(\.\d*)?\s*$"
DECIMAL = r"^\s*([+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?)\s*$"
CENSUS_NULL_MARKS = ("X", "x", ".", "-", "")


def _text(value: Column) -> Column:
    return F.trim(value.cast("string"))


def _matched(text: Column, pattern: str) -> Column:
    """First group of a match, else an empty text, which no number cast accepts.

    The text is computed once; a test followed by a cast would compute it twice.
    """
    return F.regexp_extract(text, pattern, 1)


def _with_point(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("."))


def _slash_to_iso(text: Column) -> Column:
    return F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 4, 2), F.substring(text, 1, 2))


def parse_date(value: Column) -> Column:
    """``20yy-MM-dd…`` or ``dd/MM/20yy…`` to a date; anything after the tenth character is ignored."""
    text = _text(value)
    iso = F.when(text.rlike(ISO_DATE_20XX), F.substring(text, 1, 10)).when(
        text.rlike(SLASH_DATE_20XX), _slash_to_iso(text)
    )
    return iso.try_cast("date")


def parse_timestamp(value: Column) -> Column:
    """ISO or day-first text, with or without ``HH:mm:ss``; the whole text must match."""
    iso = F.when(value.rlike(ISO_MOMENT), value).when(
        value.rlike(SLASH_MOMENT), F.concat(_slash_to_iso(value), F.substring(value, 11, 9))
    )
    return iso.try_cast("timestamp")


def parse_integer(value: Column) -> Column:
    """Digits only, to int; out of range is NULL."""
    return _matched(_text(value), DIGITS).try_cast("int")


def parse_clock(value: Column) -> Column:
    """Keep the ``HH:mm:ss`` that opens the text. Ranges are not checked."""
    return F.nullif(_matched(_text(value), CLOCK_PREFIX), F.lit(""))


def clock_hour(value: Column) -> Column:
    """Hour 0-23 of a valid ``HH:mm:ss`` text."""
    return F.when(value.rlike(CLOCK), F.substring(value, 1, 2)).try_cast("int")


def parse_coordinate(value: Column) -> Column:
    """Plain decimal number with a comma or a point, to double."""
    return _matched(_with_point(_text(value)), COORDINATE).try_cast("double")


def parse_number(value: Column) -> Column:
    """Any decimal number text to double; ``NaN``, ``Infinity`` and type suffixes are not numbers."""
    return _matched(value.cast("string"), DECIMAL).try_cast("double")


def parse_flag(value: Column) -> Column:
    """Boolean from a boolean, a number (true unless zero) or a text: ``true``, ``yes``, ``1``, ``1.0`` and so on."""
    text = F.trim(value.cast("string"))
    return F.coalesce(text.try_cast("boolean"), parse_number(text) != 0)


def census_text(value: Column) -> Column:
    """Trimmed text, NULL for the census "no value" marks."""
    text = F.trim(value)
    return F.when(~text.isin(*CENSUS_NULL_MARKS), text)


def census_bigint(value: Column) -> Column:
    """Census whole number; a decimal part is cut off. The null marks are not numbers."""
    return _matched(value, WHOLE_PART).try_cast("bigint")


def census_double(value: Column) -> Column:
    """Census decimal number, written with a comma or a point. The null marks are not numbers."""
    return parse_number(_with_point(value))
