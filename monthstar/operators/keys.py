"""Dense surrogate keys without a single-task step over the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 1024


def max_id(dimension: DataFrame, id_column: str) -> DataFrame:
    """The largest id in use, 0 for an empty dimension, as one row."""
    return dimension.agg(F.coalesce(F.max(id_column), F.lit(0).cast("bigint")).alias("max_id"))


def next_id_start(dimension: DataFrame, id_column: str) -> int:
    """The id after which new rows are numbered."""
    return max_id(dimension, id_column).first()["max_id"]


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    id_column: str,
    start: int = 0,
    buckets: int = DEFAULT_BUCKETS,
    bucket: Column | None = None,
) -> DataFrame:
    """Number rows ``start + 1 .. start + n``, the id as first column.

    Rows are spread over ``buckets`` by the remainder of a hash of their keys
    (or of ``bucket``, an integer expression) and numbered inside each bucket
    in key order. A bucket's ids begin after the rows of all lower buckets. The
    ids depend on the keys alone, not on partitioning or retries.

    Input keys are unique, so no bucket is hot. Only the bucket sizes, at most
    ``buckets`` rows, are summed in one task and broadcast. ``df`` is evaluated
    twice: pass a stored table rather than a long plan.
    """
    keys = list(keys)
    spread = F.xxhash64(*keys) if bucket is None else bucket.cast("bigint")
    columns = df.columns
    rows = df.withColumn("_bucket", F.pmod(spread, F.lit(buckets)))

    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select("_bucket", (F.sum("_size").over(running) - F.col("_size")).alias("_offset"))

    inside = Window.partitionBy("_bucket").orderBy(*keys)
    numbered = rows.withColumn("_position", F.row_number().over(inside))
    joined = numbered.join(F.broadcast(offsets), "_bucket")
    identifier = (F.lit(int(start)) + F.col("_offset") + F.col("_position")).cast("bigint")
    return joined.select(identifier.alias(id_column), *columns)
