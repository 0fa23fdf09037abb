"""Checks on stored tables, by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthstar.operators import enforce_duplicate_keys, enforce_null_keys, enforce_rows
from monthstar.sinks import overwrite_table
from monthstar.sources.files import (
    DIMENSION,
    FACT,
    LOADING,
    join_path,
    read_optional,
    read_period,
    read_table,
)

# Names of the checks, and the kind of table each looks at.
CHECKS = {
    "fact_keys": FACT,
    "fact_rows": FACT,
    "dimension_rows": DIMENSION,
    "dimension_duplicate_keys": DIMENSION,
}

CHECKED = "keys array<string>, id_column string, checked bigint, n_rows bigint"


def run_check(
    spark: SparkSession,
    root: str,
    check: str,
    table: str,
    keys: Sequence[str] = (),
    max_percent: float = 0,
    minimum: int = 0,
    period: tuple[int, int] | None = None,
    id_column: str | None = None,
) -> dict:
    """Run a check on a stored table: what it measured, or an error.

    ``fact_keys`` allows ``max_percent`` of rows with a null among ``keys``;
    ``fact_rows`` and ``dimension_rows`` ask for ``minimum`` rows;
    ``dimension_duplicate_keys`` wants every combination of ``keys`` once.
    ``period`` limits a check of a fact to one month's partition. With
    ``id_column``, a check of duplicate keys that passes leaves a mark of the
    ids it saw, and the next one compares later ids only.
    """
    if check not in CHECKS:
        raise ValueError(f"unknown check {check!r}; known: {', '.join(CHECKS)}")
    path = join_path(root, CHECKS[check], table)
    stored = read_period(spark, path, *period) if period else read_table(spark, path)
    if check == "fact_keys":
        return enforce_null_keys(stored, keys, max_percent, table=table)
    if check == "dimension_duplicate_keys":
        if id_column is not None:
            return _check_later(spark, join_path(root, LOADING, f"checked-{table}"), stored, table, keys, id_column)
        return enforce_duplicate_keys(stored, keys, table)
    return enforce_rows(stored, minimum, table=table)


def _check_later(
    spark: SparkSession, mark: str, stored: DataFrame, table: str, keys: Sequence[str], id_column: str
) -> dict:
    """Check the members above the mark of the last check that passed, then move the mark.

    Everything is checked where there is no mark, where it was left for other
    keys, and where the number of members below it has changed.
    """
    empty = spark.createDataFrame([], CHECKED)
    last = read_optional(spark, mark, empty.schema).first()
    checked = last["checked"] if last else 0
    seen = stored.agg(
        F.count_if(F.col(id_column) <= F.lit(checked)).alias("below"),
        F.coalesce(F.max(id_column), F.lit(0)).cast("bigint").alias("checked"),
        F.count(id_column).alias("n_rows"),
    ).first()
    made_for = (list(keys), id_column, seen["below"])
    if last is not None and (last["keys"], last["id_column"], last["n_rows"]) == made_for:
        measured = enforce_duplicate_keys(stored, keys, table, id_column, checked)
    else:
        measured = enforce_duplicate_keys(stored, keys, table)
    passed = [(list(keys), id_column, seen["checked"], seen["n_rows"])]
    overwrite_table(spark.createDataFrame(passed, CHECKED), mark)
    return measured
