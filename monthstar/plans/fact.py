"""Raw documents to rows of a fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthstar.errors import EmptyFactError
from monthstar.operators import Lookup, in_period, literal_period, resolve
from monthstar.operators.lookup import BROADCAST_BYTES, key_bytes
from monthstar.sinks import commit_partitions, overwrite_partitions, overwrite_table, remove
from monthstar.sources.files import (
    DIMENSION,
    FACT,
    LOADING,
    REJECT,
    empty_table,
    is_empty,
    join_path,
    read_family,
    read_table,
)
from monthstar.specs.model import Fact, Star

#: Column of rejected rows that holds a line which is no JSON.
UNREADABLE = "unreadable_line"
#: The verdict on a raw row.
ACCEPTED = "accepted"


def dimension_lookups(spark: SparkSession, root: str, star: Star, fact: Fact) -> list[Lookup]:
    """The dimensions a fact refers to, as stored under the root."""
    lookups = []
    for name in fact.dimensions:
        dimension = star.dimension(name)
        columns = [*dimension.keys, dimension.id_column]
        stored = read_table(spark, join_path(root, DIMENSION, name), columns, dimension.schema)
        lookups.append(Lookup(stored, dimension.keys, (dimension.id_column,)))
    return lookups


def fact_rows(df: DataFrame, lookups: list[Lookup], **options) -> DataFrame:
    """Ids in place of natural keys; period columns last. Options as for ``resolve``."""
    natural = {key for lookup in lookups for key in lookup.keys}
    resolved = resolve(df, lookups, sorted(natural), **options)
    period = ["year", "month"]
    return resolved.select(*[name for name in resolved.columns if name not in period], *period)


def measured_dimensions(spark: SparkSession, root: str, star: Star) -> dict[str, int]:
    """Bytes of keys and id of every dimension that a fact of the star looks up, from one job."""
    wanted = {}
    for fact in star.facts:
        wanted.update(zip(fact.dimensions, dimension_lookups(spark, root, star, fact)))
    return dict(zip(wanted, key_bytes([lookup.members() for lookup in wanted.values()])))


def judged_rows(spark: SparkSession, root: str, fact: Fact, year: int, month: int) -> DataFrame:
    """The parsed rows of a month's raw files, each with a verdict on whether it is a row of the month.

    Rows that are dated outside the month or not readably, or come from lines
    that are no JSON, are not ``accepted``; such a line is in ``unreadable_line``.
    """
    raw = read_family(spark, root, fact.family, year, month, UNREADABLE)
    inside = F.coalesce(in_period(year, month), F.lit(False))
    columns = [field.column() for field in fact.fields]
    if fact.family.format == "json":
        columns.append(F.col(UNREADABLE))
        inside = inside & F.col(UNREADABLE).isNull()
    rows = raw.select(*columns)
    rows = rows if fact.row_period else literal_period(rows, year, month)
    return rows.withColumn(ACCEPTED, inside)


def load_fact(
    spark: SparkSession,
    root: str,
    star: Star,
    fact: Fact,
    year: int,
    month: int,
    broadcast_bytes: int = BROADCAST_BYTES,
    sizes: dict[str, int] | None = None,
    versioned: bool = False,
) -> int:
    """Write a month of a fact, replacing that month only.

    Rows dated outside the month, or without a readable date, would replace
    another month's partition, and lines that are no JSON have nothing to say;
    they go to ``reject/<fact>`` instead. Returns their number. A month without
    any row of its own is an error, for nothing would replace what is stored
    for it. ``sizes`` gives the measured dimensions by name. With ``versioned``
    the month is replaced by one new version of the fact.

    The raw text is read by one job, which parts the rows by their verdict into
    a table under ``loading``; what follows reads that table.
    """
    parted = join_path(root, LOADING, "facts", fact.name)
    judged = judged_rows(spark, root, fact, year, month)
    judged.write.mode("overwrite").partitionBy(ACCEPTED).parquet(parted)
    schema = judged.drop(ACCEPTED).schema

    def part(verdict: str) -> DataFrame | None:
        folder = f"{parted}/{ACCEPTED}={verdict}"
        return None if is_empty(spark, folder) else read_table(spark, folder, schema=schema)

    accepted, rejected = part("true"), part("false")
    lookups = dimension_lookups(spark, root, star, fact)
    known = None if sizes is None else [sizes[name] for name in fact.dimensions]
    if accepted is not None:
        rows = accepted.drop(UNREADABLE)
        resolved = fact_rows(rows, lookups, broadcast_bytes=broadcast_bytes, sizes=known)
        write = commit_partitions if versioned else overwrite_partitions
        write(resolved, join_path(root, FACT, fact.name))
    path = join_path(root, REJECT, fact.name, f"run={year}-{month:02d}")
    number = 0
    if rejected is not None:
        overwrite_table(rejected, path)
        number = read_table(spark, path, schema=schema).count()
    elif not is_empty(spark, path):
        overwrite_table(empty_table(spark, schema), path)
    remove(spark, parted)
    if accepted is None:
        raise EmptyFactError(f"{fact.name}: no rows for {year}-{month:02d}")
    return number
