"""Finding the new members of a dimension."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_sources(*sources: DataFrame) -> DataFrame:
    """All rows of all sources, columns matched by name."""
    return reduce(DataFrame.unionByName, sources)


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are all present; the scan skips the others where it can."""
    return df.where(reduce(Column.__and__, [F.col(key).isNotNull() for key in keys]))


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows without any null column."""
    return df.dropna()


def dedupe_by_key(df: DataFrame, keys: Sequence[str], repeated: bool = False) -> DataFrame:
    """One row per key; among several, the one with fewest nulls, then the smallest by the other columns.

    The survivor does not depend on row order or on retries. Both aggregates
    combine before the shuffle, so a key that holds a large share of the rows
    leaves each task as one row.

    ``repeated`` says that whole rows repeat often, as members do in a month
    of documents. Copies are then folded by a hash aggregate first, and the
    sort that comparing the other columns needs runs on what is left. A plain
    ``distinct`` would not do: the optimizer drops it in front of a minimum.
    """
    keys = list(keys)
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.distinct()
    if repeated:
        copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
        df = copies.where("_copies > 0").select(*df.columns)
    nulls = reduce(Column.__add__, [F.col(name).isNull().cast("int") for name in rest])
    survivor = F.min(F.struct(nulls.alias("_nulls"), *rest)).alias("_rest")
    picked = df.groupBy(*keys).agg(survivor)
    columns = [F.col(f"_rest.{name}").alias(name) if name in rest else F.col(name) for name in df.columns]
    return picked.select(*columns)


def new_members(df: DataFrame, dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the dimension does not hold yet.

    No hint is given: the dimension grows with the data, so Spark decides from
    its size whether to broadcast its keys. Input deduplicated by the same keys
    is already partitioned for this join.
    """
    keys = list(keys)
    return df.join(dimension.select(*keys), keys, "left_anti")


def merge_members(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Members of two sources as one row per key.

    Columns come as keys, left only, right only, shared; of a shared column
    the left value wins where present. Both sides hold each key once.
    """
    keys = list(keys)
    left_only = [name for name in left.columns if name not in right.columns]
    right_only = [name for name in right.columns if name not in left.columns]
    shared = [name for name in left.columns if name in right.columns and name not in keys]
    joined = left.alias("l").join(right.alias("r"), keys, "full")
    return joined.select(
        *keys,
        *left_only,
        *right_only,
        *[F.coalesce(F.col(f"l.{name}"), F.col(f"r.{name}")).alias(name) for name in shared],
    )
