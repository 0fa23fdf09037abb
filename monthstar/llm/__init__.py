"""Operators of a training-data pipeline, their queries and the SQL of those that have one.

Every module is one operator with its own interface; ``queries`` applies them to the
tables. Nothing outside this subpackage and ``corpus_pipeline`` imports it.
"""

from __future__ import annotations

__all__ = ["ORACLES", "QUERIES"]


def __getattr__(name: str):
    # Only who asks for the queries loads all operators; a task loads what it runs.
    if name in __all__:
        from monthstar.llm import queries

        return getattr(queries, name)
    raise AttributeError(name)
