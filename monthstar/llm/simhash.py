"""SimHash fingerprints of texts and the groups that lie within a few differing bits.

Two 64-bit fingerprints that differ in at most three bits agree on at least two of
five bit ranges. So each fingerprint is sent, once for every pair of ranges, to the
shard of those that agree with it there. Shards are shuffled, not broadcast: a
broadcast would collect all fingerprints in the driver. Each shard is a BK-tree, a
node's children keyed by their distance to it, and a search follows only the edges
within the radius. A shard with more fingerprints than ``SHARD_NODES`` is cut into
several trees and its searches visit each of them, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthstar.llm.components import components
from monthstar.llm.tables import kind_of, mapped, stored, texts

#: Contract of the pipeline: words to a shingle, and bits by which linked fingerprints differ at most.
SHINGLE_WORDS = 3
RADIUS = 3
#: Seed of the shingle hash.
SEED = 42
#: Bit ranges (first bit, bits) of which linked fingerprints share two.
RANGES = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Fingerprints of one tree at most.
SHARD_NODES = 20_000
#: Rows that a task gathers before it builds the trees of the shards among them.
CHUNK_ROWS = 100_000
#: Visits of tree nodes that are held in memory at the same time, about.
CHUNK_VISITS = 1_000_000


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The unsigned fingerprint of a text; zero for a text that is null or has no word."""
    parts = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = [0, *(ends[: max(0, len(parts) - words)] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(line[a:b], SEED) for a, b in zip(starts, ends[min(words, len(parts)) - 1 :].tolist())],
        dtype=">u8",
    )
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS
) -> DataFrame:
    """``(id, fingerprint)`` of every row, the fingerprint as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, values in texts(batches, id_col, text_col):
            found = np.array([fingerprint(t, words) for t in values], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([ids, pa.array(found)], names=[id_col, "fingerprint"])

    return docs.select(id_col, text_col).transform(
        mapped,
        run, f"`{id_col}` {kind_of(docs, id_col)}, fingerprint long"
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
) -> DataFrame:
    """``(id, fingerprint, component_id)`` of every row.

    Fingerprints within ``radius`` (3 at most) differing bits are linked; the
    component is the smallest id reachable. Rows without a word have fingerprint
    zero and are linked like any other. Repeated rows keep one result row each.
    A null id takes part; it names a component only where no other id is in it.
    An empty table gives an empty result, other columns are not read.
    """
    prints = stored(fingerprints(docs, id_col, text_col, words), "fingerprints")
    named = _components(prints, id_col, radius).select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select(id_col, "fingerprint", "component_id")


def first_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
) -> DataFrame:
    """One row of each group of linked fingerprints, its columns untouched.

    It is the row of smallest id, then of smallest hash of all columns; rows
    without an id come last. Rows that share an id stay both where their texts are
    not linked, and of rows that are equal in every column one stays. The choice
    does not depend on how the rows are dealt to tasks.
    """
    names = ("__simhash_last", "__simhash_id", "__simhash_mark")
    unnamed = F.col(id_col).isNull()
    marked = docs.select("*", unnamed.alias(names[0]), F.col(id_col).alias(names[1]), F.xxhash64(*docs.columns).alias(names[2]))
    keyed = marked.select(F.struct(*names).alias("row"), F.col(text_col))
    prints = stored(fingerprints(keyed, "row", text_col, words), "fingerprints")
    lead = _components(prints, "row", radius).select("component_id.*").distinct()
    # One key of 128 bits carries both join and distinct, so rows are dealt once.
    key = F.struct(F.xxhash64(*names).alias("a"), F.xxhash64(F.lit("b"), *names).alias("b")).alias("__simhash_key")
    kept = marked.select("*", key).join(lead.select(key), "__simhash_key", "left_semi").dropDuplicates(["__simhash_key"])
    return kept.select(*docs.columns)


def _components(prints: DataFrame, id_col: str, radius: int) -> DataFrame:
    """``(fingerprint, component_id)`` of every distinct fingerprint."""
    classes = prints.groupBy("fingerprint").agg(F.min(id_col).alias("first_id"))
    found = components(links(prints.select("fingerprint").distinct(), radius))
    joined = classes.join(found, classes["fingerprint"] == found["node"], "left").select(
        "fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("component")
    )
    smallest = joined.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return joined.join(smallest, "component")


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``(a, b)`` that connect distinct fingerprints as all links within ``radius`` do.

    Linked fingerprints of a shard are returned as a star around the smallest,
    so the rows are at most as many as the fingerprints sent out.
    """
    if not 0 <= radius <= 3:
        raise ValueError("the bit ranges hold for a radius of 0 to 3")
    sent = F.array(
        *[
            F.struct(
                F.lit(k).alias("pair"),
                (_bits("fingerprint", *RANGES[i]) * F.lit(1 << 13) + _bits("fingerprint", *RANGES[j])).alias(
                    "bits"
                ),
            )
            for k, (i, j) in enumerate(combinations(range(len(RANGES)), 2))
        ]
    )
    rows = prints.select("fingerprint", F.explode(sent).alias("s")).select(
        (F.col("s.bits") * 10 + F.col("s.pair")).alias("shard"), "fingerprint"
    )
    counts = rows.groupBy("shard").count().where(F.col("count") > 1)
    trees = F.ceil(F.col("count") / SHARD_NODES).cast("int")
    kept = rows.join(counts.select("shard", trees.alias("trees")), "shard")
    own = F.pmod(F.xxhash64("fingerprint"), F.col("trees")).cast("int")
    visits = F.transform(
        F.sequence(F.lit(0), F.col("trees") - 1),
        lambda t: F.struct(F.least(t, F.col("own")).alias("low"), F.greatest(t, F.col("own")).alias("high")),
    )
    placed = (
        kept.withColumn("own", own)
        .select("shard", "fingerprint", "trees", F.explode(visits).alias("v"))
        .select("shard", "fingerprint", F.when(F.col("trees") > 1, F.xxhash64("v.low", "v.high")).otherwise(0).alias("cell"))
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, cell, value in _whole_shards(batches):
            first = np.empty(len(value), dtype=bool)
            first[0] = True
            first[1:] = (shard[1:] != shard[:-1]) | (cell[1:] != cell[:-1])
            a, b = search_shards(np.cumsum(first) - 1, value.view(np.uint64), radius)
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
                )

    return (
        placed.repartition("shard", "cell")
        .sortWithinPartitions("shard", "cell", "fingerprint")
        .select("shard", "cell", "fingerprint")
        .transform(mapped, run, "a long, b long")
    )


def _bits(column: str, first: int, bits: int):
    return F.shiftrightunsigned(column, first).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def _whole_shards(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of consecutive shards, a shard never cut."""
    held: list[np.ndarray] = []
    rows = 0

    def columns(batch: pa.RecordBatch) -> np.ndarray:
        return np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(columns(batch))
        rows += batch.num_rows
        if rows < CHUNK_ROWS:
            continue
        all_rows = np.concatenate(held, axis=1)
        last = (all_rows[:2] != all_rows[:2, -1:]).any(axis=0)
        cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
        if cut:
            yield tuple(all_rows[:, :cut])
        held, rows = [all_rows[:, cut:]], all_rows.shape[1] - cut
    if rows:
        yield tuple(np.concatenate(held, axis=1))


def build_trees(shard: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One BK-tree for each shard: the root of every row's tree, and ``child[node, distance]`` (-1: none).

    ``shard`` ascends. Rows go down their trees together: all that stand at the
    same node with the same distance follow the same edge, and the first of
    them becomes the child where there is none yet.
    """
    n = len(prints)
    child = np.full((n, 65), -1, dtype=np.int32)
    starts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
    root = np.repeat(starts, np.diff(np.r_[starts, n]))
    rows = np.setdiff1d(np.arange(n), starts, assume_unique=True)
    at = root[rows]
    while len(rows):
        edge = at * 65 + np.bitwise_count(prints[rows] ^ prints[at])
        _, first = np.unique(edge, return_index=True)
        child.reshape(-1)[edge[first]] = rows[first]
        below = child.reshape(-1)[edge].astype(np.int64)
        left = below != rows
        rows, at = rows[left], below[left]
    return root, child


def search_shards(shard: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars that connect the fingerprints of each shard as their links do."""
    root, child = build_trees(shard, prints)
    n = len(prints)
    label = np.arange(n)
    size = np.bincount(shard)[shard]
    block = np.cumsum(size) // CHUNK_VISITS
    for rows in np.split(np.arange(n), np.flatnonzero(np.diff(block)) + 1):
        query, node = rows, root[rows]
        ours, theirs = [], []
        while len(query):
            distance = np.bitwise_count(prints[query] ^ prints[node]).astype(np.int64)
            near = (distance <= radius) & (node < query)
            ours.append(query[near])
            theirs.append(node[near])
            asked, below = [], []
            for step in range(-radius, radius + 1):
                edge = distance + step
                fits = np.flatnonzero((edge >= 0) & (edge <= 64))
                next_node = child[node[fits], edge[fits]]
                there = next_node >= 0
                asked.append(query[fits[there]])
                below.append(next_node[there].astype(np.int64))
            query, node = np.concatenate(asked), np.concatenate(below)
        label = merge_labels(label, np.concatenate(ours), np.concatenate(theirs))
    linked = np.flatnonzero(label != np.arange(n))
    return prints[linked], prints[label[linked]]


def merge_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each the smallest row of its group) after the groups of ``a`` and ``b`` are joined."""
    while len(a):
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        differ = low != high
        a, b, low, high = a[differ], b[differ], low[differ], high[differ]
        np.minimum.at(label, high, low)
        while True:
            shorter = label[label]
            if np.array_equal(shorter, label):
                break
            label = shorter
    return label
