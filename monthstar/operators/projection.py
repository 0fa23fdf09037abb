"""Projections: renaming raw columns, struct fields, periods."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthstar.specs.model import Field


def rename(df: DataFrame, fields: Iterable[Field]) -> DataFrame:
    """Select the given fields under their new names, parsed where they say so.

    One projection only: the scan below reads just the columns named here, and
    struct paths are pruned down to their leaves.
    """
    return df.select(*[field.column() for field in fields])


def literal_period(df: DataFrame, year: int, month: int) -> DataFrame:
    """Add the run's period as constant ``year`` and ``month``."""
    return df.withColumns({"year": F.lit(int(year)), "month": F.lit(int(month))})


def in_period(year: int, month: int, day: str | None = None) -> Column:
    """Predicate for one period.

    On the partition columns of a fact it prunes folders. ``day`` names a date
    column of a table without them; a range on it lets the scan skip blocks.
    """
    if day is None:
        return (F.col("year") == int(year)) & (F.col("month") == int(month))
    first = date(int(year), int(month), 1)
    following = date(first.year + first.month // 12, first.month % 12 + 1, 1)
    return (F.col(day) >= F.lit(first)) & (F.col(day) < F.lit(following))


def split_period(df: DataFrame, year: int, month: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the period, and all others, null periods included."""
    inside = F.coalesce(in_period(year, month), F.lit(False))
    return df.where(inside), df.where(~inside)
