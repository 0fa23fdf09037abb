"""DataFrame to DataFrame operators of a star-schema load."""

from monthstar.operators.keys import max_id, next_id_start, number_rows
from monthstar.operators.lookup import Lookup, key_bytes, resolve
from monthstar.operators.members import (
    dedupe_by_key,
    drop_incomplete,
    drop_null_keys,
    merge_members,
    new_members,
    union_sources,
)
from monthstar.operators.projection import in_period, literal_period, rename, split_period
from monthstar.operators.quality import (
    duplicate_keys,
    enforce_duplicate_keys,
    enforce_null_keys,
    enforce_rows,
    null_keys,
    row_count,
)

__all__ = [
    "Lookup",
    "dedupe_by_key",
    "drop_incomplete",
    "drop_null_keys",
    "duplicate_keys",
    "enforce_duplicate_keys",
    "enforce_null_keys",
    "enforce_rows",
    "in_period",
    "key_bytes",
    "literal_period",
    "max_id",
    "merge_members",
    "new_members",
    "next_id_start",
    "null_keys",
    "number_rows",
    "rename",
    "resolve",
    "row_count",
    "split_period",
    "union_sources",
]
