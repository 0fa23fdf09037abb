"""Writing staging tables, dimensions, facts and raw records."""

from monthstar.sinks.tables import (
    append_dimension,
    land_records,
    overwrite_partitions,
    overwrite_table,
    remove,
    scratch_folder,
)
from monthstar.sinks.versions import commit_partitions, commit_rows, drop_unused

__all__ = [
    "append_dimension",
    "commit_partitions",
    "commit_rows",
    "drop_unused",
    "land_records",
    "overwrite_partitions",
    "overwrite_table",
    "remove",
    "scratch_folder",
]
