"""Raw files and stored tables under one root folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthstar.sources.arrays import read_arrays
from monthstar.sources.versions import is_versioned, read_parts, read_version
from monthstar.specs.model import Family

STAGING = "staging"
DIMENSION = "dimension"
FACT = "fact"
LOADING = "loading"
REJECT = "reject"
#: The setting that says how much of a file a task reads.
SHARE = "spark.sql.files.maxPartitionBytes"


def join_path(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def read_csv(spark: SparkSession, path: str, separator: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """Delimited files with a header; every column is text.

    Columns take their names from the header of one file; a file that has them
    in another order is an error. Records are one line each, so large files are
    split, and only the selected columns are parsed.
    """
    return spark.read.csv(path, sep=separator, encoding=encoding, header=True, enforceSchema=False)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | str, unreadable: str | None = None
) -> DataFrame:
    """JSON under a given schema: one object per line, or an array per line.

    A line that is no JSON becomes a row of nulls; ``unreadable`` names a column
    that then holds the line. Files that begin with an array and are larger than
    a task's share are read by several tasks, wherever their lines end.
    """
    arrays, others = _large_arrays(spark, path)
    if not arrays:
        return _read_json_lines(spark, path, schema, unreadable)
    found = read_arrays(spark, arrays, schema, unreadable)
    return found.unionByName(_read_json_lines(spark, others, schema, unreadable)) if others else found


def _read_json_lines(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str, unreadable: str | None
) -> DataFrame:
    if unreadable is None:
        return spark.read.schema(schema).json(path)
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    marked = T.StructType([*declared.fields, T.StructField(unreadable, T.StringType())])
    return spark.read.schema(marked).option("columnNameOfCorruptRecord", unreadable).json(path)


def _large_arrays(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """Files of a path that begin with an array and are worth splitting, and all others if there are such.

    Only files larger than a task's share are opened, for their first characters.
    """
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    pattern = jvm.org.apache.hadoop.fs.Path(path)
    system = pattern.getFileSystem(hadoop)
    share = jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(SHARE))
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(hadoop)
    files = []
    for status in system.globStatus(pattern) or ():
        files += system.listStatus(status.getPath()) if status.isDirectory() else [status]
    files = [file for file in files if not file.getPath().getName().startswith(("_", "."))]

    def begins_array(file) -> bool:
        if file.isDirectory() or file.getLen() <= share or codecs.getCodec(file.getPath()) is not None:
            return False
        stream = system.open(file.getPath())
        try:
            first = next((c for c in iter(stream.read, -1) if c not in b" \t\r\n\xef\xbb\xbf"), -1)
        finally:
            stream.close()
        return first == ord("[")

    arrays = [begins_array(file) for file in files]
    names = [file.getPath().toString() for file in files]
    if not any(arrays):
        return [], []
    return [n for n, a in zip(names, arrays) if a], [n for n, a in zip(names, arrays) if not a]


def read_family(
    spark: SparkSession, root: str, family: Family, year: int, month: int, unreadable: str | None = None
) -> DataFrame:
    """The raw files of one month, picked by name; none at all is an error.

    ``unreadable`` names a column for lines of JSON families that are no JSON.
    """
    path = join_path(root, family.glob(year, month))
    if family.format == "json":
        return read_json(spark, path, family.schema, unreadable)
    return read_csv(spark, path, family.separator, family.encoding)


def read_table(
    spark: SparkSession, path: str, columns: Sequence[str] = (), schema: T.StructType | None = None
) -> DataFrame:
    """A stored table, all columns or the named ones; a schema that is given is not inferred by a job.

    Of a versioned table this is the last version; one without any version is an error.
    """
    if is_versioned(spark, path):
        table = read_parts(spark, path, read_version(spark, path), schema)
        if table is None:
            raise FileNotFoundError(f"{path}: no version yet")
        return table.select(*columns) if columns else table
    table = spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
    return table.select(*columns) if columns else table


def paths_like(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders whose path matches a glob, on any file system that Spark reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().toString() for status in system.globStatus(path) or ()]


def is_empty(spark: SparkSession, path: str) -> bool:
    """Whether nothing is there, or a folder without any file, or no version; only the path itself is listed."""
    if is_versioned(spark, path):
        return not read_version(spark, path).parts
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(where):
        return True
    return all(
        status.getPath().getName().startswith(("_", ".")) for status in system.listStatus(where)
    )


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of a schema, in a form the optimizer sees to be empty."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).where(F.lit(False)).select(*columns)


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table, or an empty one of this schema where there is none yet.

    There is none where the path is absent, or is a folder without any file, as
    a first write that failed leaves behind. Any other failure is raised: a
    table that cannot be read must not pass for one that does not exist.
    """
    return empty_table(spark, schema) if is_empty(spark, path) else read_table(spark, path, schema=schema)


def read_period(spark: SparkSession, path: str, year: int, month: int) -> DataFrame:
    """One month of a stored fact. Only its own folder is listed.

    A month that is not there has no rows; a fact that is not there is an error.
    """
    period = f"year={int(year)}/month={int(month)}"
    if is_versioned(spark, path):
        version = read_version(spark, path)
        rows = read_parts(spark, path, version, partition=period)
        return read_table(spark, path).where(F.lit(False)) if rows is None else rows
    folder = f"{path}/{period}"
    if is_empty(spark, folder):
        return spark.read.parquet(path).where(F.lit(False))
    return spark.read.option("basePath", path).parquet(folder)


def read_staged(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All staging tables whose name ends with the table's name."""
    return spark.read.parquet(join_path(root, STAGING, f"*{table}"))
