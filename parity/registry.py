"""Query name to Spark function, and to the SQL with the same result."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from monthstar.sinks import scratch_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL where there is one."""

    def add(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql.strip()
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder for a query's own files; a local session without a checkpoint folder gets one here."""
    context = spark.sparkContext
    if not (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()):
        if context.master.startswith("local"):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="monthstar-"))
    return scratch_folder(spark, label)
