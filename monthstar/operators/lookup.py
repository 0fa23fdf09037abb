"""Replacing natural keys by surrogate ids."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of all dimensions together that one run of lookups broadcasts.
BROADCAST_BYTES = 128 * 1024 * 1024
#: Frequent keys of a large lookup that are spread, and the tasks each is spread over.
HEAVY_KEYS = 256
SALTS = 32
ROW_OVERHEAD_BYTES = 64

# Frequent keys are counted in slices of the hash range, each by a sketch of
# bounded size, so that no single task merges the sketches of all others.
SLICES = 64
SLICE_KEYS = 64
SLICE_TRACKED = 1024


@dataclass(frozen=True)
class Lookup:
    """A dimension, the natural key to match and the columns to fetch."""

    dimension: DataFrame
    keys: tuple[str, ...]
    fetch: tuple[str, ...]

    def members(self) -> DataFrame:
        return self.dimension.select(*self.keys, *self.fetch)


def key_bytes(tables: Sequence[DataFrame]) -> list[int]:
    """Bytes the rows of each table take in memory, from one aggregate over each."""
    sizes = []
    for number, members in enumerate(tables):
        strings = [f.name for f in members.schema.fields if isinstance(f.dataType, T.StringType)]
        size = F.count(F.lit(1)) * (ROW_OVERHEAD_BYTES + 8 * len(members.columns))
        for name in strings:
            size = size + F.coalesce(F.sum(F.octet_length(name)), F.lit(0))
        sizes.append(members.agg(F.lit(number).alias("number"), size.alias("bytes")))
    if not sizes:
        return []
    measured = reduce(DataFrame.unionByName, sizes).collect()
    return [row["bytes"] for row in sorted(measured, key=lambda row: row["number"])]


def resolve(
    df: DataFrame,
    lookups: Sequence[Lookup],
    drop: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
    heavy_keys: int = HEAVY_KEYS,
    sizes: Sequence[int] | None = None,
) -> DataFrame:
    """Left-join what each lookup fetches, then drop the named natural keys.

    Lookups run in order; a later one may match on what an earlier one
    fetched. Rows without a match keep nulls. Dimensions hold each key once, as
    their duplicate check makes sure. The smallest dimensions that together
    measure ``broadcast_bytes`` at most are broadcast, so the facts are not
    shuffled; ``sizes`` gives the measures where they are known. Larger ones
    are joined by shuffle: rows with a null key, and those with a frequent one,
    are spread over several tasks, and the members of frequent keys repeated
    for each. The rows are read once, and once more by a sketch of the keys of
    all large lookups. Keys that an earlier lookup fetches are left to Spark's
    own splitting of skewed partitions.
    """
    tables = [lookup.members() for lookup in lookups]
    if sizes is None:
        sizes = key_bytes(tables)
    for lookup, members in zip(lookups, tables):
        fetched = {name: field for other in tables for name, field in zip(other.columns, other.schema.fields)}
        for key in lookup.keys:
            mine = df.schema[key] if key in df.columns else fetched[key]
            if mine.dataType != members.schema[key].dataType:
                raise ValueError(f"key {key!r} has another type in the dimension")
    left, small = broadcast_bytes, set()
    for number in sorted(range(len(sizes)), key=sizes.__getitem__):
        if sizes[number] <= left:
            small.add(number)
            left -= sizes[number]
    large = [n for n in range(len(lookups)) if n not in small and set(lookups[n].keys) <= set(df.columns)]
    heavy = _heavy_hashes(df, [lookups[n].keys for n in large], heavy_keys) if large else []
    hot = dict(zip(large, heavy))
    for number, (lookup, members) in enumerate(zip(lookups, tables)):
        keys = list(lookup.keys)
        if number in small:
            df = df.join(F.broadcast(members), keys, "left")
        else:
            df = _spread_lookup(df, members, keys, hot.get(number, []))
    return df.drop(*drop)


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(key).isNull() for key in keys])


def _heavy_hashes(df: DataFrame, keys: Sequence[Sequence[str]], limit: int) -> list[list[int]]:
    """For each key, the hashes of its most frequent values, ``limit`` at most; one pass of the rows.

    The counts are estimates. They only choose how far a row is spread; the
    result is the same whichever keys are found.
    """
    marks = F.array(
        *[
            F.when(~_any_null(key), F.struct(F.lit(n).alias("_key"), F.xxhash64(*key).alias("_hash")))
            for n, key in enumerate(keys)
        ]
    )
    hashes = df.select(F.inline(F.filter(marks, lambda mark: mark.isNotNull())))
    frequent = F.call_function("approx_top_k", F.col("_hash"), F.lit(SLICE_KEYS), F.lit(SLICE_TRACKED))
    slices = hashes.groupBy("_key", F.pmod("_hash", F.lit(SLICES))).agg(frequent.alias("_top"))
    found = slices.select("_key", F.inline("_top"))
    first = Window.partitionBy("_key").orderBy(F.desc("count"), "item")
    top = found.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= limit).collect()
    return [[row["item"] for row in top if row["_key"] == n] for n in range(len(keys))]


def _spread_lookup(
    df: DataFrame, members: DataFrame, keys: Sequence[str], heavy_hashes: Sequence[int]
) -> DataFrame:
    """A left join by shuffle in which neither null nor frequent keys meet in one task.

    Such rows get a salt from the row itself, so a retried task deals them the
    same way. The members repeated are as few as the hashes given, times ``SALTS``.
    """
    heavy = F.xxhash64(*keys).isin(list(heavy_hashes)) if heavy_hashes else F.lit(False)
    dealt = F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int")
    salted = df.withColumn("_salt", F.when(heavy | _any_null(keys), dealt).otherwise(F.lit(0)))
    salts = F.sequence(F.lit(0), F.when(heavy, F.lit(SALTS - 1)).otherwise(F.lit(0)))
    repeated = members.withColumn("_salt", F.explode(salts))
    return salted.join(repeated, [*keys, "_salt"], "left").drop("_salt")
