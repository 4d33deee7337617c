"""Cleaning and converting single cells, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import REDACTED, SSN_PATTERN, TRUE_WORDS
from .names import strip

NUMBER_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def without_null_bytes(text: Column) -> Column:
    return F.replace(text, F.lit("\x00"), F.lit(""))


def is_blank(value: Column, kind: str = "string") -> Column:
    """Null, white space only, or an empty collection."""
    if kind == "collection":
        return value.isNull() | (F.size(value) == 0)
    return value.isNull() | ~value.rlike(r"\S")


def text_number(text: Column, kind: str = "double") -> Column:
    """Number in text with thousands commas; anything else becomes null."""
    plain = strip(F.replace(text, F.lit(","), F.lit("")))
    return F.when(plain.rlike(NUMBER_TEXT), plain.try_cast(kind))


def exact_double(text: Column) -> Column:
    """Number in text as a double; null for a whole number that a double cannot hold as it is written."""
    value = text_number(text)
    whole = text_number(text, "decimal(38,0)")
    plain = strip(F.replace(text, F.lit(","), F.lit("")))
    changed = plain.rlike(r"^[+-]?\d+$") & (whole.isNull() | (value.try_cast("decimal(38,0)") != whole))
    return F.when(~F.coalesce(changed, F.lit(False)), value)


def whole_number(text: Column) -> Column:
    """Whole number in text, exact to 38 digits; anything with a fraction or an exponent is null."""
    plain = strip(F.replace(text, F.lit(","), F.lit("")))
    return F.when(plain.rlike(r"^[+-]?\d+$"), plain.try_cast("decimal(38,0)"))


def yes_no(text: Column) -> Column:
    """'Y' for a true word, 'N' for any other text."""
    return F.when(text.isNotNull(), F.when(F.lower(strip(text)).isin(*TRUE_WORDS, "y"), "Y").otherwise("N"))


def normalise_cell(text: Column, kind: str) -> Column:
    """Clean one text cell for a column of type ``kind``.

    Null bytes go first and blank text is null for every type.  ``number`` may
    name a decimal type (``decimal(15,2)``); ``clob`` keeps its outer spaces.
    ``number`` is a double, and null for long whole numbers that it would change;
    ``whole`` holds them exactly, ``text`` as they are.
    """
    clean = without_null_bytes(text)
    clean = F.when(clean.rlike(r"\S"), clean)
    if kind == "boolean":
        return yes_no(clean)
    if kind == "number":
        return exact_double(clean)
    if kind == "whole":
        return whole_number(clean)
    if kind.startswith("decimal"):
        return text_number(clean, kind)
    if kind == "date":
        day = F.substring(strip(clean), 1, 10)
        return F.when(day.rlike(r"^\d{4}-\d{2}-\d{2}$"), day.try_cast("date"))
    if kind == "timestamp":
        return strip(clean).try_cast("timestamp_ntz")
    if kind == "clob":
        return clean
    return strip(clean)


def true_word(text: Column) -> Column:
    return F.lower(text).isin(*TRUE_WORDS)


def coerce(text: Column, kind: str) -> Column:
    """Text to ``kind``; null stays null; ``array<t>`` splits on commas."""
    if kind.startswith("array<"):
        item = kind[len("array<"):-1]
        return F.transform(F.split(text, ","), lambda x: coerce(strip(x), item))
    if kind == "boolean":
        return true_word(text)
    if kind == "string":
        return text
    return strip(text).try_cast(kind)


def redact_ssn(text: Column, token: str = REDACTED) -> Column:
    return F.regexp_replace(text, SSN_PATTERN, token)


def nine_digit_runs(text: Column) -> Column:
    """All nine-digit runs once spaces and dashes are removed (never across lines)."""
    return F.regexp_extract_all(F.regexp_replace(text, "[ -]", ""), F.lit(r"\d{9}"), F.lit(0))
