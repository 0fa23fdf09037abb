"""Writers of versioned tables: files first, then one new list of folders.

Readers see the version before until the list is there, and all of the new one
after it. A writer that is lost in between leaves folders that nothing names.
The list is put in its place by a rename that does not replace, so of two
writers that began with the same version the second is refused. On object
stores this holds as far as their rename does.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from monthstar.errors import VersionConflictError
from monthstar.sinks.tables import PERIOD, remove
from monthstar.sources.versions import (
    COMMIT,
    DATA,
    VERSIONS,
    Version,
    hadoop_path,
    read_version,
    version_numbers,
)


def commit_rows(df: DataFrame, path: str, base: Version | None = None) -> int:
    """Add rows to a versioned table; the number of the new version.

    ``base`` is the version that the rows were made from (the last one by
    default). Where another writer has moved the table on, nothing is added.
    """
    spark = df.sparkSession
    base, commit, folder = _begin(spark, path, base)
    return _finish(spark, path, base, folder, lambda: (df.write.parquet(folder), [*base.parts, (commit, "")])[1])


def commit_partitions(
    df: DataFrame, path: str, by: Sequence[str] = PERIOD, base: Version | None = None, gather: bool = False
) -> int:
    """Replace those partitions of a versioned table that ``df`` has rows for, all at once.

    The other partitions keep their folders. ``base`` and the result are those
    of ``commit_rows``, ``gather`` that of ``overwrite_partitions``.
    """
    spark = df.sparkSession
    base, commit, folder = _begin(spark, path, base)
    rows = df.hint("rebalance", *by) if gather else df

    def write() -> list[tuple[str, str]]:
        rows.write.partitionBy(*by).parquet(folder)
        written = _partitions(spark, folder, len(by))
        kept = [part for part in base.parts if part[1] not in set(written)]
        return [*kept, *((commit, partition) for partition in written)]

    return _finish(spark, path, base, folder, write)


def drop_unused(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete versions before the last ``keep``, and folders that none of these name; the folders deleted.

    No writer may be at work, and no reader on an older version.
    """
    numbers = version_numbers(spark, path)
    last = numbers[-keep:]
    named = {part for number in last for part in read_version(spark, path, number).parts}
    for number in numbers[:-keep]:
        remove(spark, f"{path}/{VERSIONS}/{number:012d}.json")
    where, system = hadoop_path(spark, f"{path}/{DATA}")
    dropped = []
    for status in system.listStatus(where) if system.exists(where) else ():
        folder = status.getPath().toString()
        commit = status.getPath().getName().removeprefix(f"{COMMIT}=")
        used = {partition for c, partition in named if c == commit}
        depth = max((partition.count("/") + 1 for partition in used if partition), default=0)
        unused = [] if used else [folder]
        if depth:
            unused = [f"{folder}/{p}" for p in _partitions(spark, folder, depth) if p not in used]
        for where_unused in unused:
            remove(spark, where_unused)
        dropped += unused
    return dropped


def _begin(spark: SparkSession, path: str, base: Version | None) -> tuple[Version, str, str]:
    base = read_version(spark, path) if base is None else base
    where, system = hadoop_path(spark, f"{path}/{VERSIONS}")
    system.mkdirs(where)
    commit = uuid.uuid4().hex
    return base, commit, f"{path}/{DATA}/{COMMIT}={commit}"


def _finish(spark: SparkSession, path: str, base: Version, folder: str, write) -> int:
    try:
        parts = write()
        _publish(spark, path, base, parts)
    except BaseException:
        remove(spark, folder)
        raise
    return base.number + 1


def _publish(spark: SparkSession, path: str, base: Version, parts: list[tuple[str, str]]) -> None:
    number = base.number + 1
    last = max(version_numbers(spark, path), default=0)
    if last != base.number:
        raise VersionConflictError(f"{path}: made from version {base.number}, but {last} is the last")
    draft, system = hadoop_path(spark, f"{path}/{VERSIONS}/.{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    try:
        stream.write(json.dumps({"parts": parts}).encode("utf-8"))
    finally:
        stream.close()
    final, _ = hadoop_path(spark, f"{path}/{VERSIONS}/{number:012d}.json")
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), hadoop)
    keep_existing = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(system.makeQualified(draft), system.makeQualified(final), keep_existing)
    except Py4JJavaError as error:
        system.delete(draft, False)
        if "FileAlreadyExistsException" not in error.java_exception.toString():
            raise
        raise VersionConflictError(f"{path}: version {number} is there already") from error


def _partitions(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """Paths of the partitions in a folder, relative to it."""
    where, system = hadoop_path(spark, folder)
    found = [""]
    for _ in range(depth):
        below = []
        for part in found:
            inside, _ = hadoop_path(spark, f"{folder}/{part}" if part else folder)
            names = [s.getPath().getName() for s in system.listStatus(inside) if s.isDirectory()]
            below += [f"{part}/{name}" if part else name for name in sorted(names) if "=" in name]
        found = below
    return found
