"""Scalar column expressions for text exports with decimal commas."""

from monthstar.functions.text import (
    all_but_yes,
    br_date,
    br_number,
    month_of,
    request_date,
    request_month,
    year_of,
)

__all__ = [
    "all_but_yes",
    "br_date",
    "br_number",
    "month_of",
    "request_date",
    "request_month",
    "year_of",
]
