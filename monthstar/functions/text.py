"""Parsing of dates, amounts and flags held as text.

Every function is a built-in column expression, so it stays inside generated
code. Bad input becomes null whatever the session's ANSI setting is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date pattern, decimal and thousands marks, the word for yes.
DATE_PATTERN = "dd/MM/yyyy"
MONTH_PATTERN = "MM/yyyy"
DECIMAL_MARK = ","
THOUSANDS_MARK = "."
YES = "SIM"

NUMBER_MODES = ("thousands", "comma_only")


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def br_date(value: Column | str) -> Column:
    """Date from ``dd/MM/yyyy`` text; anything else is null."""
    return F.try_to_date(_column(value), DATE_PATTERN)


def br_number(value: Column | str, mode: str = "thousands") -> Column:
    """Double from text such as ``1.234,56``.

    ``thousands`` removes thousands marks before the decimal comma is turned
    into a point. ``comma_only`` turns commas only, so text with a thousands
    mark has two points and becomes null.
    """
    if mode not in NUMBER_MODES:
        raise ValueError(f"number mode must be one of {NUMBER_MODES}, not {mode!r}")
    text = F.trim(_column(value))
    if mode == "thousands":
        text = F.replace(text, F.lit(THOUSANDS_MARK), F.lit(""))
    return F.replace(text, F.lit(DECIMAL_MARK), F.lit(".")).try_cast("double")


def all_but_yes(value: Column | str) -> Column:
    """False for the word yes, true for any other text and for null."""
    return F.when(_column(value) == YES, F.lit(False)).otherwise(F.lit(True))


def year_of(day: Column | str) -> Column:
    return F.year(_column(day))


def month_of(day: Column | str) -> Column:
    return F.month(_column(day))


def request_date(day: Column | str) -> Column:
    """A date as the paged service expects it, ``dd/MM/yyyy``."""
    return F.date_format(_column(day).cast("date"), DATE_PATTERN)


def request_month(day: Column | str) -> Column:
    """A month as the paged service expects it, ``MM/yyyy``."""
    return F.date_format(_column(day).cast("date"), MONTH_PATTERN)
