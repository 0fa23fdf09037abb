"""Writers. Each takes a DataFrame and a folder on storage all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

PERIOD = ("year", "month")


def overwrite_table(df: DataFrame, path: str) -> None:
    """Replace a staging table."""
    df.write.mode("overwrite").parquet(path)


def append_dimension(df: DataFrame, path: str) -> None:
    """Add rows to a dimension."""
    df.write.mode("append").parquet(path)


def overwrite_partitions(
    df: DataFrame, path: str, by: Sequence[str] = PERIOD, gather: bool = False
) -> None:
    """Replace only those partitions of a fact that ``df`` has rows for.

    The overwrite mode is set on this write, not on the session. Rows of one
    period need no shuffle. With many periods ``gather`` brings the rows of a
    partition together, so that not every task writes to every folder; Spark
    splits partitions that come out too large.
    """
    by = list(by)
    if gather:
        df = df.hint("rebalance", *by)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def land_records(df: DataFrame, path: str, column: str | None = None, file_records: int = 0) -> None:
    """Write raw records as JSON lines, non-ASCII text kept.

    ``column`` names a column that holds records as JSON text already; without
    it every row becomes an object. ``file_records`` above 0 compresses the
    files, which then do not split, and puts at most so many records into one.
    """
    writer = (df if column is None else df.select(column)).write.mode("overwrite")
    if file_records > 0:
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", file_records)
    if column is None:
        writer.json(path)
    else:
        writer.text(path)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder under the checkpoint folder that the session or its context names."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/monthstar-{uuid.uuid4().hex}/{label}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, on any file system that Spark reads; nothing there is no error."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
