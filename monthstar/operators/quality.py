"""Quality measures as one-row DataFrames, and checks that raise on them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthstar.errors import DuplicateKeyError, EmptyFactError, NullKeyError, TooFewRowsError
from monthstar.operators.projection import in_period


def null_keys(df: DataFrame, keys: Sequence[str], period: tuple[int, int] | None = None) -> DataFrame:
    """Rows, rows with any null key, and their percentage, in one pass.

    The percentage is null when there are no rows.
    """
    if not keys:
        raise KeyError("name at least one key column to check")
    if period is not None:
        df = df.where(in_period(*period))
    missing = reduce(Column.__or__, [F.col(key).isNull() for key in keys])
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(missing).alias("null_key_rows"),
    )
    share = F.try_divide(F.col("null_key_rows") * F.lit(100.0), F.col("total_rows"))
    return counts.withColumn("null_key_pct", share)


def row_count(df: DataFrame, minimum: int = 0, period: tuple[int, int] | None = None) -> DataFrame:
    """Rows, and whether there are at least ``minimum`` of them."""
    if period is not None:
        df = df.where(in_period(*period))
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("passed", F.col("n_rows") >= F.lit(int(minimum)))


def duplicate_keys(
    df: DataFrame, keys: Sequence[str], id_column: str | None = None, checked: int = 0
) -> DataFrame:
    """Number of keys held by more than one row; null keys count as equal.

    With ``id_column``, rows with ids up to ``checked`` are known to hold every key
    once. Only later rows are grouped then, those without an id too; of the earlier
    ones just those remain that hold a later row's key. Where these keys are few by
    Spark's own measure, the earlier rows are read but not shuffled.
    """
    if id_column is None:
        groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    else:
        earlier = F.coalesce(F.col(id_column) <= F.lit(int(checked)), F.lit(False))
        later = df.where(~earlier).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        asked = later.select(*[F.col(key).alias(f"_later_{key}") for key in keys])
        same = reduce(Column.__and__, [F.col(key).eqNullSafe(F.col(f"_later_{key}")) for key in keys])
        met = df.where(earlier).select(*keys).join(asked, same, "left_semi")
        rows = later.unionByName(met.withColumn("_rows", F.lit(1).cast("long")))
        groups = rows.groupBy(*keys).agg(F.sum("_rows").alias("_rows"))
    return groups.where("_rows > 1").agg(F.count(F.lit(1)).alias("duplicate_keys"))


def enforce_null_keys(
    df: DataFrame,
    keys: Sequence[str],
    max_percent: float = 0,
    period: tuple[int, int] | None = None,
    table: str = "fact",
) -> dict:
    """Raise unless rows exist and no more than ``max_percent`` lack a key."""
    measured = null_keys(df, keys, period).first().asDict()
    if measured["total_rows"] == 0:
        raise EmptyFactError(f"{table}: no rows to check")
    if measured["null_key_pct"] > max_percent:
        raise NullKeyError(f"{table}: {measured['null_key_pct']} percent null keys, allowed {max_percent}")
    return measured


def enforce_rows(
    df: DataFrame, minimum: int = 0, period: tuple[int, int] | None = None, table: str = "table"
) -> dict:
    """Raise when there are fewer than ``minimum`` rows."""
    measured = row_count(df, minimum, period).first().asDict()
    if not measured["passed"]:
        raise TooFewRowsError(f"{table}: {measured['n_rows']} rows, expected {minimum} or more")
    return measured


def enforce_duplicate_keys(
    df: DataFrame,
    keys: Sequence[str],
    table: str = "dimension",
    id_column: str | None = None,
    checked: int = 0,
) -> dict:
    """Raise when a key occurs more than once; rows with ids up to ``checked`` have passed before."""
    measured = duplicate_keys(df, keys, id_column, checked).first().asDict()
    if measured["duplicate_keys"] > 0:
        raise DuplicateKeyError(f"{table}: {measured['duplicate_keys']} duplicate keys on {list(keys)}")
    return measured
