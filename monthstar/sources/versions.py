"""Versions of a stored table.

A versioned table holds its files under ``data/commit=<id>/`` and a list of the
folders that belong to it under ``_versions/<number>.json``. The list with the
largest number is the table; folders that no list names are not part of it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

VERSIONS = "_versions"
DATA = "data"
COMMIT = "commit"


@dataclass(frozen=True)
class Version:
    """A number, and the folders of a table as pairs of commit and partition (empty without partitions)."""

    number: int = 0
    parts: tuple[tuple[str, str], ...] = ()


def hadoop_path(spark: SparkSession, path: str):
    """A path and the file system it is on, whichever Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def is_versioned(spark: SparkSession, path: str) -> bool:
    where, system = hadoop_path(spark, path)
    return system.isDirectory(where) and system.exists(hadoop_path(spark, f"{path}/{VERSIONS}")[0])


def version_numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that are kept, rising."""
    if not is_versioned(spark, path):
        return []
    where, system = hadoop_path(spark, f"{path}/{VERSIONS}")
    names = [status.getPath().getName() for status in system.listStatus(where)]
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))


def read_version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """The version of this number, or the last; number 0 without parts where there is none yet."""
    if number is None:
        number = max(version_numbers(spark, path), default=0)
    if number == 0:
        return Version()
    where, system = hadoop_path(spark, f"{path}/{VERSIONS}/{number:012d}.json")
    stream = system.open(where)
    try:
        kept = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Version(number, tuple((commit, partition) for commit, partition in kept["parts"]))


def read_parts(
    spark: SparkSession, path: str, version: Version, schema: T.StructType | None = None, partition: str | None = None
) -> DataFrame | None:
    """The rows of a version, or of one partition of it; only its own folders are listed. None without any folder.

    The folders are named to one scan, so that filters and columns reach all of them.
    """
    folders = [
        f"{path}/{DATA}/{COMMIT}={commit}" + (f"/{part}" if part else "")
        for commit, part in version.parts
        if partition in (None, part)
    ]
    if not folders:
        return None
    reader = spark.read.option("basePath", f"{path}/{DATA}")
    if schema is not None:
        return reader.schema(schema).parquet(*folders).select(*schema.names)
    return reader.parquet(*folders).drop(COMMIT)
