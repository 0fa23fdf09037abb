"""Staged members to numbered rows of a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from monthstar.operators import (
    drop_incomplete,
    drop_null_keys,
    merge_members,
    new_members,
    next_id_start,
    number_rows,
)
from monthstar.operators.keys import DEFAULT_BUCKETS
from monthstar.sinks import append_dimension, commit_rows, overwrite_table
from monthstar.sources.files import (
    DIMENSION,
    LOADING,
    STAGING,
    join_path,
    read_optional,
    read_table,
)
from monthstar.sources.versions import read_version
from monthstar.specs.model import Dimension


def staged_members(spark: SparkSession, root: str, dimension: Dimension, strict: bool = False) -> DataFrame:
    """The staged rows of all sources of a dimension, one per key.

    Each source is read from the staging table of its own name. Where two are
    merged, rows with a null key are dropped, and with ``strict`` rows with any
    null column; staging keeps the fullest record of a key, so a member that
    has a complete one stays.
    """
    sides = [
        read_table(spark, join_path(root, STAGING, source.name), schema=source.schema)
        for source in dimension.sources
    ]
    if len(sides) == 1:
        return sides[0]
    kept = [drop_incomplete(side) if strict else drop_null_keys(side, dimension.keys) for side in sides]
    return merge_members(*kept, dimension.keys)


def load_dimension(
    spark: SparkSession,
    root: str,
    dimension: Dimension,
    strict: bool = False,
    buckets: int = DEFAULT_BUCKETS,
    versioned: bool = False,
) -> None:
    """Append the staged members that are not in the dimension yet.

    Staged rows are compared with the dimension once more, so a load that is
    repeated after its append adds nothing. The rows to add are stored first:
    numbering reads them twice, and the dimension is not read by the job that
    appends to it. ``buckets`` is the number of tasks that number rows; give a
    dimension the same number every time, since ids of new members depend on it.

    With ``versioned`` the rows become a new version, unless another load has
    moved the dimension on since this one read it: no id is given twice.
    """
    path = join_path(root, DIMENSION, dimension.name)
    pending = join_path(root, LOADING, dimension.name)
    base = read_version(spark, path) if versioned else None
    known = read_optional(spark, path, dimension.schema)
    overwrite_table(new_members(staged_members(spark, root, dimension, strict), known, dimension.keys), pending)

    numbered = number_rows(
        read_table(spark, pending, schema=dimension.member_schema),
        dimension.keys,
        dimension.id_column,
        start=next_id_start(known, dimension.id_column),
        buckets=buckets,
        bucket=dimension.bucket() if dimension.bucket else None,
    )
    if versioned:
        commit_rows(numbered.select(*dimension.columns), path, base)
    else:
        append_dimension(numbered.select(*dimension.columns), path)
