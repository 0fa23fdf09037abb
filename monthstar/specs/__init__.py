"""Declarations of raw files, dimensions and facts."""

from monthstar.specs.model import (
    Dimension,
    Fact,
    Family,
    Field,
    Star,
    StagedSource,
    amount,
    day,
    flag,
    leaf,
    month_field,
    text,
    year_field,
)

__all__ = [
    "Dimension",
    "Fact",
    "Family",
    "Field",
    "StagedSource",
    "Star",
    "amount",
    "day",
    "flag",
    "leaf",
    "month_field",
    "text",
    "year_field",
]
