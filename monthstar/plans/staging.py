"""Raw files to staged new members of a dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthstar.operators import dedupe_by_key, drop_null_keys, new_members, rename, union_sources
from monthstar.sinks import overwrite_table
from monthstar.sources.files import (
    DIMENSION,
    LOADING,
    STAGING,
    join_path,
    read_family,
    read_optional,
)
from monthstar.specs.model import Dimension, Family, Field, StagedSource, Star

#: Columns of one pass: a grouping id has 64 bits.
GROUPING_COLUMNS = 64


def read_families(
    spark: SparkSession, root: str, families: Sequence[Family], fields: Sequence[Field], year: int, month: int
) -> DataFrame:
    """The same columns of several families' files of a month, all rows."""
    tables = [rename(read_family(spark, root, family, year, month), fields) for family in families]
    return union_sources(*tables)


def stage_members(
    rows: DataFrame, dimension: DataFrame, keys: Sequence[str], repeated: bool = True
) -> DataFrame:
    """The new members among rows: complete keys, one row each, not known yet."""
    members = dedupe_by_key(drop_null_keys(rows, keys), keys, repeated)
    return new_members(members, dimension, keys)


def stage_source(
    spark: SparkSession,
    root: str,
    dimension: Dimension,
    source: StagedSource,
    year: int,
    month: int,
    rows: DataFrame | None = None,
) -> None:
    """Stage one side's new members of a dimension for a month.

    ``rows`` gives the side's distinct rows where they have been read already.
    """
    repeated = rows is None
    if rows is None:
        rows = read_families(spark, root, source.families, source.fields, year, month)
    known = read_optional(spark, join_path(root, DIMENSION, dimension.name), dimension.schema)
    staged = stage_members(rows, known, dimension.keys, repeated)
    overwrite_table(staged, join_path(root, STAGING, source.name))


def shared_passes(star: Star) -> list[tuple[tuple[Family, ...], tuple[StagedSource, ...]]]:
    """Passes over raw families, each with the staged sources that it folds.

    Sources of the same families are packed into as few passes as their columns
    allow. A source alone in its pass is folded by ``stage_source`` itself.
    """
    groups: dict[tuple[Family, ...], list[StagedSource]] = {}
    for dimension in star.dimensions:
        for source in dimension.sources:
            groups.setdefault(source.families, []).append(source)
    packed: list[tuple[tuple[Family, ...], list[StagedSource]]] = []
    for families, sources in groups.items():
        passes: list[list[StagedSource]] = []
        for source in sorted(sources, key=lambda s: -len(s.fields)):
            for one in passes:
                if sum(len(s.fields) for s in one) + len(source.fields) <= GROUPING_COLUMNS:
                    one.append(source)
                    break
            else:
                passes.append([source])
        packed += [(families, one) for one in passes]
    return [(families, tuple(one)) for families, one in packed if len(one) > 1]


def distinct_rows(
    spark: SparkSession,
    root: str,
    families: Sequence[Family],
    sources: Sequence[StagedSource],
    year: int,
    month: int,
) -> dict[str, DataFrame]:
    """The distinct rows of several sources over one pass of their raw files.

    Each source is a grouping set: rows are folded by hash before the shuffle,
    whatever share of them a member holds. The result is stored by source, and
    what is returned, by source name, reads its own part only.
    """
    wide = [Field(f"{source.name}__{f.name}", f.source, f.parse) for source in sources for f in source.fields]
    sets = [[f"{source.name}__{f.name}" for f in source.fields] for source in sources]
    rows = read_families(spark, root, families, wide, year, month)

    grouped = F.lit(None)
    for source, columns in zip(sources, sets):
        grouped = F.when(F.grouping(columns[0]) == 0, F.lit(source.name)).otherwise(grouped)
    folded = rows.groupingSets(sets, *[f.name for f in wide]).agg(grouped.alias("source"))
    path = join_path(root, LOADING, "members", "_".join(source.name for source in sources))
    folded.write.mode("overwrite").partitionBy("source").parquet(path)

    # The schema is given because a month without any member has no file to take it from.
    stored = spark.read.schema(folded.schema).parquet(path)
    parts = {}
    for source, columns in zip(sources, sets):
        own = [F.col(column).alias(f.name) for column, f in zip(columns, source.fields)]
        parts[source.name] = stored.where(F.col("source") == source.name).select(*own)
    return parts
