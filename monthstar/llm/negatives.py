"""Hard negatives by BOND: branch and bound over vertically stored vectors.

Rows are kept in blocks, each dimension of a block one contiguous column with its
least and largest entry. An anchor reads the columns of a block in the order of its
own largest entries. What the columns it has not read can still add to a score lies
between two sums of products with those extremes; rows that these bounds rule out
leave the candidate bitmap, until the few that are left have been read whole and
their scores are exact.

The anchors are a query set that meets all rows: they are broadcast in chunks of a
stated size, and each chunk passes over the blocks twice. The first pass
finds the positives of every anchor, which state the windows of scores that the
second looks for. A task returns its best few for each anchor, and those of all tasks
meet by anchor, so no group of rows ever lies in one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthstar.llm.tables import kind_of, mapped, shared_folder, stored

#: A component ``x`` becomes ``floor(SCALE * x)``.
SCALE = 256
#: Positives of an anchor, and negatives of each positive.
POSITIVES, NEGATIVES = 5, 3
#: Percent of a positive's score that a negative's lies between.
WINDOW = (50, 95)
#: Components at and beyond this would make scores that no long holds.
LARGEST = 2.0**16
#: Rows of a block, entries of the anchors that are broadcast together, and columns read between two looks at the bounds.
BLOCK_ROWS, CHUNK_ENTRIES, STEP = 4096, 1 << 21, 8


@dataclass
class Block:
    """Rows of one vector length, sorted by label; ``columns`` has a line for each dimension."""

    rows: np.ndarray
    ids: list
    labels: np.ndarray
    columns: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def labelled(self, label) -> tuple[int, int]:
        """The range of rows that have this label."""
        return int(np.searchsorted(self.labels, label)), int(np.searchsorted(self.labels, label, "right"))


class Anchor:
    """An anchor's components in the order in which it reads columns."""

    def __init__(self, row: int, id, label, vector: np.ndarray):
        self.row, self.id, self.label = row, id, label
        self.order = np.argsort(-np.abs(vector), kind="stable")
        self.vector = vector[self.order]

    def left(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """The least and the most that the columns from each place of the order on add to a score."""
        a, b = self.vector * block.low[self.order], self.vector * block.high[self.order]
        ends = np.zeros(1, a.dtype)
        least, most = np.minimum(a, b)[::-1].cumsum()[::-1], np.maximum(a, b)[::-1].cumsum()[::-1]
        return np.concatenate([least, ends]), np.concatenate([most, ends])


def scan(anchor: Anchor, block: Block, alive: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the bitmap that ``keep`` never rules out, and their exact scores.

    ``keep(rows, least, most)`` gets the bounds of the scores of the rows left and
    returns a bitmap of them.
    """
    least, most = anchor.left(block)
    rows = np.flatnonzero(alive)
    score = np.zeros(len(rows), least.dtype)
    places = [*range(0, len(anchor.vector), STEP), len(anchor.vector)]
    for at, to in zip(places, [*places[1:], None]):
        stay = keep(rows, score + least[at], score + most[at])
        if not stay.all():
            rows, score = rows[stay], score[stay]
        if to is None or not len(rows):
            break
        columns = anchor.order[at:to]
        read = block.columns[columns] if len(rows) == len(block.rows) else block.columns[columns[:, None], rows]
        score = score + anchor.vector[at:to].astype(score.dtype) @ read.astype(score.dtype, copy=False)
    return rows, score


class Best:
    """The first few of all rows met so far: higher scores, then smaller ids, come first."""

    def __init__(self, few: int):
        self.few = few
        self.found: list[tuple] = []

    def bar(self) -> float:
        """A score below this is not among them."""
        return -self.found[-1][0] if len(self.found) == self.few else -np.inf

    def add(self, block: Block, rows: np.ndarray, score: np.ndarray) -> None:
        if len(rows) > self.few:
            near = score >= np.partition(score, -self.few)[-self.few]
            rows, score = rows[near], score[near]
        met = [(-s, block.ids[r], int(block.rows[r])) for r, s in zip(rows.tolist(), score.tolist())]
        self.found = sorted(self.found + met)[: self.few]


def _bar(bound: np.ndarray, few: int) -> float:
    """A score that at least ``few`` of the rows reach, by their least scores."""
    return np.partition(bound, -few)[-few].item() if len(bound) >= few else -np.inf


def seek_positives(anchor: Anchor, block: Block, best: Best) -> None:
    """Adds the rows of a block that have the anchor's label, itself left out."""
    first, end = block.labelled(anchor.label)
    if first == end:
        return
    alive = np.zeros(len(block.rows), bool)
    alive[first:end] = block.rows[first:end] != anchor.row

    def keep(rows: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        return most >= max(best.bar(), _bar(least, best.few))

    best.add(block, *scan(anchor, block, alive, keep))


def window(score: int) -> tuple[int, int]:
    """The least and the largest whole score inside the window of a positive."""
    return -(-WINDOW[0] * score // 100), WINDOW[1] * score // 100


def seek_negatives(anchor: Anchor, block: Block, windows: list[tuple[int, int, Best]]) -> None:
    """Adds rows of a block with another label to the windows ``(least, largest, best)`` that they are in."""
    first, end = block.labelled(anchor.label)
    if end - first == len(block.rows):
        return
    alive = np.ones(len(block.rows), bool)
    alive[first:end] = False

    def keep(rows: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(rows), bool)
        for low, high, best in windows:
            inside = (least >= low) & (most <= high)
            bar = max(low, best.bar(), _bar(least[inside], best.few))
            stay |= (most >= bar) & (least <= high)
        return stay

    rows, score = scan(anchor, block, alive, keep)
    for low, high, best in windows:
        inside = (score >= low) & (score <= high)
        best.add(block, rows[inside], score[inside])


_BLOCK = "d int, rows array<long>, ids array<{id}>, labels array<{label}>, columns binary, low binary, high binary"


def blocks(rows: DataFrame, tasks: int) -> DataFrame:
    """Rows ``(row, id, label, x array<int>)`` as blocks, sorted by length and label: one row for each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, length = 0, None

        def packed() -> pa.RecordBatch:
            group = pa.Table.from_batches(held).combine_chunks()
            x = np.stack(group.column("x").to_numpy()).T.astype("<i4")
            lists = [group.column(name).combine_chunks() for name in ("row", "id", "label")]
            lists = [pa.ListArray.from_arrays(pa.array([0, group.num_rows], pa.int32()), v) for v in lists]
            parts = [np.ascontiguousarray(x), x.min(axis=1), x.max(axis=1)]
            return pa.RecordBatch.from_arrays(
                [pa.array([len(x)], pa.int32()), *lists, *[pa.array([p.tobytes()], pa.binary()) for p in parts]],
                names=["d", "rows", "ids", "labels", "columns", "low", "high"],
            )

        for batch in batches:
            lengths = batch.column(4).to_numpy()
            cuts = np.flatnonzero(np.diff(lengths)) + 1
            for start, end in zip(np.r_[0, cuts], np.r_[cuts, len(lengths)]):
                if start == end:
                    continue
                if held and lengths[start] != length:
                    yield packed()
                    held, size = [], 0
                length = lengths[start]
                while start < end:
                    taken = min(end - start, BLOCK_ROWS - size)
                    held.append(batch.slice(start, taken))
                    start, size = start + taken, size + taken
                    if size == BLOCK_ROWS:
                        yield packed()
                        held, size = [], 0
        if held:
            yield packed()

    order = ["d", "label", "row"]
    placed = rows.select("row", "id", "label", "x", F.size("x").alias("d"))
    return (
        placed.repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
        .transform(mapped, run, _BLOCK.format(id=kind_of(rows, "id"), label=kind_of(rows, "label")))
    )


def _block(row: dict) -> Block:
    n, d = len(row["rows"]), row["d"]
    columns, low, high = (np.frombuffer(row[name], "<i4") for name in ("columns", "low", "high"))
    # Sums below 2^53 are exact as doubles, which are fastest; others are whole numbers of 64 bits.
    exact = np.float64 if max(-int(low.min()), int(high.max())) ** 2 * d < 2**53 else np.int64
    columns, low, high = columns.reshape(d, n).astype(exact), low.astype(exact), high.astype(exact)
    return Block(np.array(row["rows"], np.int64), row["ids"], np.array(row["labels"]), columns, low, high)


def _blocks_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, Block]]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            yield row["d"], _block(row)


def _anchors(chunk: list[dict]) -> dict[int, list[Anchor]]:
    """Anchors by vector length."""
    out: dict[int, list[Anchor]] = {}
    for row in chunk:
        block = _block(row)
        out.setdefault(row["d"], []).extend(
            Anchor(int(block.rows[k]), block.ids[k], block.labels[k], np.ascontiguousarray(block.columns[:, k]))
            for k in range(len(block.rows))
        )
    return out


def _usable(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, anchors: Column) -> DataFrame:
    v = F.col("v")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST)))
    picked = vectors.select(
        F.col(id_col).alias("id"),
        F.col(label_col).alias("label"),
        F.col(vec_col).cast("array<double>").alias("v"),
        F.coalesce(anchors, F.lit(False)).alias("asks"),
    )
    kept = picked.where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite
    )
    return kept.select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        "label",
        "asks",
        F.transform(v, lambda c: F.floor(c * SCALE).cast("int")).alias("x"),
    )


def _first(rows: DataFrame, keys: list[str], few: int) -> DataFrame:
    """The first few rows of each key by score and id, numbered; each task hands on no more than these."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "row")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= few)


def _found(best: dict[tuple, Best], kinds: list[tuple[str, pa.DataType]]) -> Iterator[pa.RecordBatch]:
    """A row for each key and each of its best: the key, then score, id and row."""
    out = [(*key, int(-s), id, row) for key, few in best.items() for s, id, row in few.found]
    for start in range(0, len(out), 20_000):
        columns = list(zip(*out[start : start + 20_000]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, (_, kind) in zip(columns, kinds)], names=[name for name, _ in kinds]
        )


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchors`` tells which rows are anchors. Components become whole numbers and
    scores are their exact inner products. An anchor's positives are the first
    ``POSITIVES`` other rows of its label; each has the first ``NEGATIVES`` rows of
    other labels whose score lies in the ``WINDOW`` of its own. Higher scores come
    first, then smaller ids; rows that share an id too are ordered by their place.

    Rows without an id, label or vector, with an empty vector, or with a
    component that is null, not finite, or of 2^16 and more take no part.
    Vectors of different lengths do not meet. Rows that repeat an id, or a row
    wholly, are rows of their own. An empty table gives an empty result; other
    columns are not read.
    """
    spark = vectors.sparkSession
    rows = _usable(vectors, id_col, vec_col, label_col, anchors)
    tasks = max(1, vectors.rdd.getNumPartitions())
    every = stored(blocks(rows.drop("asks"), tasks), "blocks")
    asking = stored(blocks(rows.where("asks").drop("asks"), tasks), "anchors")
    id_type = every.schema["ids"].dataType.elementType.simpleString()
    id_kind = asking.select("ids").limit(0).toArrow().schema.field(0).type.value_type

    path = f"{shared_folder(spark)}/monthstar-llm-{uuid.uuid4().hex}/negatives"
    schema = (
        f"anchor_id {id_type}, positive_id {id_type}, rank int, negative_id {id_type}, positive_score long, "
        "negative_score long"
    )
    spark.createDataFrame([], schema).write.parquet(path)
    for chunk in _chunks(asking):
        _mined(every, chunk, id_type, id_kind).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _chunks(asking: DataFrame) -> Iterator[list[dict]]:
    """Blocks of anchors, as many at a time as hold ``CHUNK_ENTRIES`` and one block more at most."""
    chunk: list[dict] = []
    held = 0
    for row in asking.toLocalIterator():
        chunk.append(row.asDict())
        held += len(row["rows"]) * row["d"]
        if held >= CHUNK_ENTRIES:
            yield chunk
            chunk, held = [], 0
    if chunk:
        yield chunk


def _mined(every: DataFrame, chunk: list[dict], id_type: str, id_kind: pa.DataType) -> DataFrame:
    """The negatives of one chunk of anchors."""
    context = every.sparkSession.sparkContext
    sent = context.broadcast(_anchors(chunk))

    def positives(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, Best] = {}
        for d, block in _blocks_of(batches):
            for anchor in sent.value.get(d, ()):
                seek_positives(anchor, block, best.setdefault((anchor.row,), Best(POSITIVES)))
        kinds = [("anchor", pa.int64()), ("score", pa.int64()), ("id", id_kind), ("row", pa.int64())]
        yield from _found(best, kinds)

    met = every.transform(mapped, positives, f"anchor long, score long, id {id_type}, row long")
    first = _first(met, ["anchor"], POSITIVES).select("anchor", "rank", "id", "score")
    windows: dict[int, list[tuple]] = {}
    for row in first.orderBy("anchor", "rank").collect():
        windows.setdefault(row["anchor"], []).append((row["rank"], row["id"], row["score"]))
    told = context.broadcast(windows)

    def negatives(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, Best] = {}
        for d, block in _blocks_of(batches):
            for anchor in sent.value.get(d, ()):
                mine = []
                for place, id, score in told.value.get(anchor.row, ()):
                    low, high = window(score)
                    if low <= high:
                        key = (anchor.row, anchor.id, place, id, score)
                        mine.append((low, high, best.setdefault(key, Best(NEGATIVES))))
                if mine:
                    seek_negatives(anchor, block, mine)
        kinds = [("anchor", pa.int64()), ("anchor_id", id_kind), ("place", pa.int32()), ("positive_id", id_kind)]
        kinds += [("positive_score", pa.int64()), ("score", pa.int64()), ("id", id_kind), ("row", pa.int64())]
        yield from _found(best, kinds)

    found = every.transform(
        mapped,
        negatives,
        f"anchor long, anchor_id {id_type}, place int, positive_id {id_type}, positive_score long, score long, "
        f"id {id_type}, row long",
    )
    return _first(found, ["anchor", "place"], NEGATIVES).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
