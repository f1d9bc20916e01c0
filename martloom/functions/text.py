"""Defensive cleaning of staging text into typed columns.

Blank text and NULL are different values in staging data, so every function says
what it does with each.  Patterns end in ``\\z``: in Java ``$`` also matches before
a trailing line break.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The accepted text forms.
DIGITS = r"^[0-9]+\z"
SIGNED_DECIMAL = r"^-?[0-9]*\.?[0-9]+\z"
TAIL_DATE = r"^[0-9]{2}/[0-9]{2}/[0-9]{2}\z"

MEASURE_TYPE = "decimal(20,6)"


def is_digits(text: Column) -> Column:
    return F.trim(text).rlike(DIGITS)


def digits_or_zero(text: Column, to: str = "int") -> Column:
    """Trimmed digits as a number, anything else 0.  Too many digits raise."""
    return F.when(is_digits(text), F.trim(text).cast(to)).otherwise(F.lit(0).cast(to))


def digits_or_null(text: Column) -> Column:
    """Trimmed digits, still text, so that ``007`` and ``7`` stay different keys."""
    return F.when(is_digits(text), F.trim(text))


def decimal_or_zero(text: Column, to: str = MEASURE_TYPE) -> Column:
    """A plain signed decimal as a number, anything else 0."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(SIGNED_DECIMAL), trimmed.cast(to)).otherwise(F.lit(0).cast(to))


def is_not_blank(text: Column) -> Column:
    """True for text other than ``''``; NULL text gives NULL, so a filter drops it."""
    return text != ""


def blank_to_null(text: Column) -> Column:
    """Blank text becomes NULL; other text is kept with its spaces."""
    return F.when(F.trim(text) != "", text)


def date_or_null(text: Column) -> Column:
    """Blank text becomes NULL, ISO text a date; malformed text raises."""
    return F.when(F.trim(text) != "", F.trim(text).cast("date"))


def tail_text(text: Column) -> Column:
    """The last eight characters, where descriptions carry ``MM/DD/YY``."""
    return F.right(F.trim(text), F.lit(8))


def has_tail_date(text: Column) -> Column:
    return tail_text(text).rlike(TAIL_DATE)


def tail_date(text: Column) -> Column:
    """The date at the end of a description, days and months rolling over.

    02/30/20 is 2020-03-01.  Two-digit years from 70 on belong to the 1900s.
    Apply to rows that pass ``has_tail_date``.
    """
    tail = tail_text(text)
    month = F.substring(tail, 1, 2).cast("int")
    day = F.substring(tail, 4, 2).cast("int")
    short_year = F.substring(tail, 7, 2).cast("int")
    year = short_year + F.when(short_year >= 70, 1900).otherwise(2000)
    january = F.make_date(year, F.lit(1), F.lit(1))
    return F.date_add(F.add_months(january, month - 1), day - 1)


def text_timestamp(date_text: Column, time_text: Column) -> Column:
    """Date text and time text joined into one timestamp."""
    joined = F.concat(date_text.cast("string"), F.lit(" "), time_text.cast("string"))
    return joined.cast("timestamp_ntz")


def padded_code(text: Column, width: int = 10) -> Column:
    """Zero-padded on the left to ``width``; longer text keeps its left part."""
    return F.lpad(text, width, "0")
