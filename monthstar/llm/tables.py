"""Input tables, and tables that hand work over between jobs."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a local session without one gets its own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="monthstar-llm-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The same rows as a written table in the shared folder: later jobs read it, nothing is recomputed.

    What the write shuffled is removed when it has ended, not when the driver next collects garbage.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/monthstar-llm-{uuid.uuid4().hex}/{label}"
    before = spark.conf.get(CLEANUP_SETTING)
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP_SETTING, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table of ``stored`` that nothing reads any more."""
    spark = table.sparkSession
    for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model here learns from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def kind_of(df: DataFrame, column: str) -> str:
    """The type of a column as DDL."""
    return df.schema[column].dataType.simpleString()


def mapped(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` over batches of bounded size.

    Spark's batches of whole documents may be large, and each is held by Spark and
    by Python at once. A session with a larger bound gets ``BATCH_BYTES``. Workers
    outlive their tasks, so each gives back its memory when a task ends.
    """

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    conf = df.sparkSession.conf
    if int(re.match(r"-?\d+", conf.get(BATCH_SETTING))[0]) not in range(1, BATCH_BYTES + 1):
        conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return df.mapInArrow(task, schema)


def give_back() -> None:
    """Return free memory of this process to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def texts(
    batches: Iterable[pa.RecordBatch], id_col: str, text_col: str, as_bytes: bool = False
) -> Iterator[tuple[pa.Array, list]]:
    """Ids as they came and texts as Python strings (or UTF-8), a bounded slice of a batch at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            values = part.column(part.schema.get_field_index(text_col))
            if as_bytes:
                values = values.cast(pa.binary())
            yield part.column(part.schema.get_field_index(id_col)), values.to_pylist()


def kept_rows(docs: DataFrame, text_col: str, keep) -> DataFrame:
    """Rows whose text ``keep`` accepts, all their columns untouched and nothing shuffled.

    ``keep`` takes a list of texts and returns a list of booleans.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                values = part.column(part.schema.get_field_index(text_col)).to_pylist()
                yield part.filter(pa.array(keep(values), pa.bool_()))

    return mapped(docs, run, docs.schema)


#: Bytes of an Arrow batch, about, and the setting that bounds them.
BATCH_BYTES = 8 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
#: The setting by which a query removes its shuffle files when it ends.
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows whose texts are Python objects at the same time.
SLICE_ROWS = 512
