"""Reading raw files, stored tables and paged services."""

from monthstar.sources.arrays import read_arrays
from monthstar.sources.files import (
    read_csv,
    read_family,
    read_json,
    read_optional,
    read_period,
    read_staged,
    read_table,
)
from monthstar.sources.paged import PagedJsonSource, fetch_pages, register
from monthstar.sources.requests import EXTRACTIONS, Extraction, agency_requests, extraction, month_requests
from monthstar.sources.transports import HttpGet, RecordedPages, Reply

__all__ = [
    "EXTRACTIONS",
    "Extraction",
    "HttpGet",
    "PagedJsonSource",
    "RecordedPages",
    "Reply",
    "agency_requests",
    "extraction",
    "fetch_pages",
    "month_requests",
    "read_arrays",
    "read_csv",
    "read_family",
    "read_json",
    "read_optional",
    "read_period",
    "read_staged",
    "read_table",
    "register",
]
