"""Queries on the driver's tables, each with the SQL that states its result."""

from parity import basics, files, flows, spending  # noqa: F401  (they register their queries)
from parity.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
