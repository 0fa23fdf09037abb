"""Near-duplicate vectors by randomised-rotation binary codes.

Vectors are turned by a random rotation; the signs of the result are the code, and
the code's inner product with the turned vector is stored as its correction factor.
Dividing the product of a code and another turned vector by that factor estimates
the cosine without bias, with an error bound that follows from the factor. Only
pairs whose upper bound reaches the threshold are computed again, in double
precision; the result rests on those.

Pairs are met in cells around centres fitted on a bounded sample. A vector lives in
the cell of its nearest centre and visits the other cells that a neighbour may live
in: two linked vectors are no farther apart than the threshold allows, so the one
nearer to the plane between their centres is within half of that. The bound holds for
any data; where it makes vectors visit many cells, fewer and larger cells are used.
Every vector is indexed. A cell's own vectors and its visitors are cut into blocks
that meet pairwise, so a task holds three bounded blocks at most; links leave a block
as counts and as stars, never as pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthstar.llm.components import components
from monthstar.llm.simhash import merge_labels
from monthstar.llm.tables import mapped, stored

#: Least cosine of a link.
COSINE = 0.9
#: Vectors of the sample that centres are fitted on, centres at most, and rounds of the fit.
SAMPLE, CENTRES, ROUNDS = 10_000, 4096, 6
#: Standard deviations of the bound on estimates.
CONFIDENCE = 4.0
#: Added to the reach across cell borders, for rounding.
ROUNDING = 1e-6
#: Vectors that visits are counted on to choose the centres, and estimates that cost as much as placing a vector.
TRIED, ROW_ESTIMATES = 1024, 2000
#: Vectors of one block of a cell, or of its visitors, about.
BLOCK_VECTORS = 4096
#: Entries of a matrix of estimates.
TILE = 1 << 21
SEED = 5


def rotation(d: int) -> np.ndarray:
    """A random orthogonal matrix: ``d`` columns, rows filled up to a multiple of 64."""
    wide = -(-d // 64) * 64
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((wide, wide)))
    return (q * np.sign(np.diag(r)))[:, :d].astype(np.float32)


def codes(units: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Binary codes of unit vectors (packed bits) and their correction factors."""
    turned = units.astype(np.float32) @ turn.T
    factor = np.abs(turned).sum(axis=1) / math.sqrt(turn.shape[0])
    return np.packbits(turned > 0, axis=1), factor.astype(np.float32)


def fit_centres(sample: np.ndarray, k: int) -> np.ndarray:
    """Unit centres by spherical k-means from evenly spaced rows of the sample."""
    centres = sample[np.linspace(0, len(sample) - 1, k).astype(int)].copy()
    for _ in range(ROUNDS):
        home = np.argmax(sample @ centres.T, axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, home, sample)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        centres = np.where(norm > 0, total / np.maximum(norm, 1e-30), centres)
    return centres


def reaches(centres: np.ndarray, cosine: float) -> np.ndarray:
    """How much nearer to its own centre than to another a vector may be that visits the other's cell.

    For linked ``u`` and ``v`` with centres ``a`` and ``b``, ``u(a - b)`` and ``v(b - a)`` are not
    negative and add up to ``(u - v)(a - b)``, at most the distances' product; the smaller is half of it at most.
    """
    return (math.sqrt(max(0.0, 2 - 2 * cosine)) / 2 * _apart(centres) + ROUNDING).astype(np.float32)


def chosen_centres(sample: np.ndarray, total: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Centres and their reaches, of the number by which a vector costs least; all numbers find the same links."""
    k = min(CENTRES, math.isqrt(total) + 1, len(sample))
    best = None
    while True:
        centres = fit_centres(sample, k)
        reach = reaches(centres, cosine)
        tried = sample[:TRIED]
        home, visits = cells(tried, centres, reach)
        size = np.bincount(home, minlength=k) * (total / len(tried))
        cost = float((visits @ (size + ROW_ESTIMATES * np.maximum(1, size / BLOCK_VECTORS))).mean())
        if best is None or cost < best[0]:
            best = cost, centres, reach
        if k == 1:
            return best[1:]
        k //= 2


def cells(units: np.ndarray, centres: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each vector, and for each cell whether the vector visits it; it does its home."""
    near = units @ centres.T
    home = np.argmax(near, axis=1)
    short = near[np.arange(len(home)), home][:, None] - near <= reach[home]
    short[np.arange(len(home)), home] = True
    return home, short


def _valid(vectors: DataFrame, vec_col: str) -> DataFrame:
    """Rows whose vector has finite components only, and one that is not zero."""
    v = F.col(vec_col)
    finite = F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vectors.where(v.isNotNull() & finite & F.exists(v, lambda x: x != 0))


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE
) -> DataFrame:
    """``(id, n_links, component_id, kept)`` of every row.

    Vectors that are null, empty or zero, or hold a null or non-finite component,
    link with nothing, and vectors of different lengths do not link. Equal vectors
    are one vector with a count until the end, so a group of copies of any size is
    one row in its cell. Rows with a null id are counted as links of others; their
    component is the smallest id reachable, if there is one. Other columns are not read.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    good = _valid(rows, "v")
    distinct = stored(
        good.groupBy("v").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .select(F.monotonically_increasing_id().alias("rep"), "v", "first_id", "copies", F.size("v").alias("d")),
        "distinct",
    )
    found = None
    for size in sorted(row["d"] for row in distinct.select("d").distinct().collect()):
        part = stored(_met(distinct.where(F.col("d") == size), size, cosine), "links")
        found = part if found is None else found.unionByName(part)
    if found is None:
        named = distinct.select("v", F.lit(0).cast("long").alias("n_links"), F.col("first_id").alias("component_id"))
    else:
        linked = found.where(F.col("n") > 0).groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "rep")
        joined = components(found.where(F.col("n") == 0).select("a", "b")).withColumnRenamed("node", "rep")
        whole = distinct.join(linked, "rep", "left").join(joined, "rep", "left").withColumn(
            "component", F.coalesce("component", "rep")
        )
        smallest = whole.groupBy("component").agg(F.min("first_id").alias("component_id"))
        named = whole.join(smallest, "component").select(
            "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
        )
    out = rows.join(named, "v", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def _met(distinct: DataFrame, d: int, cosine: float) -> DataFrame:
    """``(a, b, n)``: rows with ``n = 0`` are links of a star, others add ``n`` links to ``a``."""
    spark = distinct.sparkSession
    total = distinct.count()
    sample = np.array(
        [row["v"] for row in distinct.orderBy(F.xxhash64("rep"), "rep").select("v").limit(SAMPLE).collect()]
    )
    turn = rotation(d)
    centres, reach = chosen_centres(_units(sample), total, cosine)
    sent = spark.sparkContext.broadcast((turn, centres, reach))

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, centres, reach = sent.value
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                values = np.stack(part.column(1).to_numpy(zero_copy_only=False)).astype(np.float64)
                units = _units(values)
                home, visits = cells(units, centres, reach)
                bits, factor = codes(units, turn)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(list(values), pa.list_(pa.float64())),
                        part.column(2),
                        pa.array([b.tobytes() for b in bits], pa.binary()),
                        pa.array(factor, pa.float32()),
                        pa.array(home, pa.int32()),
                        pa.array([np.flatnonzero(row) for row in visits], pa.list_(pa.int32())),
                        pa.array([b.tobytes() for b in np.packbits(visits, axis=1)], pa.binary()),
                    ],
                    names=["rep", "v", "copies", "code", "factor", "home", "visits", "visited"],
                )

    indexed = stored(
        distinct.select("rep", "v", "copies").transform(
            mapped,
            index,
            "rep long, v array<double>, copies long, code binary, factor float, home int, visits array<int>, "
            "visited binary",
        ),
        "index",
    )
    return (
        _placed(indexed).repartition("cell", "low", "high")
        .sortWithinPartitions("cell", "low", "high")
        .transform(mapped, lambda batches: _links(batches, sent.value[0], cosine), "a long, b long, n long")
    )


def _placed(indexed: DataFrame) -> DataFrame:
    """Every vector in all groups ``(cell, low, high)`` that it belongs to.

    The cell's own blocks ``low`` and ``high`` meet each other; where they are one
    block, it meets the first block of visitors too. Further blocks of visitors
    meet each own block with ``low`` negative.
    """
    entered = indexed.withColumn("cell", F.explode("visits")).drop("visits")
    lives = F.col("home") == F.col("cell")
    sizes = entered.groupBy("cell").agg(
        F.ceil(F.count_if(lives) / BLOCK_VECTORS).cast("int").alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.count_if(~lives) / BLOCK_VECTORS)).cast("int").alias("visiting"),
    )
    placed = entered.join(F.broadcast(sizes), "cell").withColumn(
        "block",
        F.pmod(F.xxhash64("rep"), F.when(lives, F.col("blocks")).otherwise(F.col("visiting"))).cast("int"),
    )
    own = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least("block", k).alias("low"), F.greatest("block", k).alias("high")),
    )
    met = F.transform(
        F.sequence(F.lit(1) - F.col("visiting"), F.lit(0)),
        lambda k: F.struct(k.alias("low"), F.col("block").alias("high")),
    )
    visits = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.when(F.col("block") == 0, k).otherwise(-F.col("block")).alias("low"), k.alias("high")),
    )
    # The first block of visitors comes to the group where a block meets itself.
    at_home = F.concat(own, F.filter(met, lambda g: g["low"] < 0))
    columns = ["block", "rep", "v", "copies", "code", "factor", "home", "visited"]
    return (
        placed.where(F.col("blocks") > 0)
        .withColumn("group", F.explode(F.when(lives, at_home).otherwise(visits)))
        .select("cell", "group.low", "group.high", *columns)
    )


def _apart(centres: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (centres @ centres.T)))


def _units(values: np.ndarray) -> np.ndarray:
    scaled = values / np.abs(values).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _links(batches: Iterable[pa.RecordBatch], turn: np.ndarray, cosine: float) -> Iterator[pa.RecordBatch]:
    """Links of each group of rows with the same cell and pair of blocks."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for start, end in zip(np.r_[0, cuts], np.r_[cuts, len(keys)]):
            if key is not None and (keys[start] != key).any():
                yield from _group_links(held, turn, cosine)
                held = []
            key = keys[start]
            held.append(batch.slice(start, end - start))
    if held:
        yield from _group_links(held, turn, cosine)


def _group_links(held: list[pa.RecordBatch], turn: np.ndarray, cosine: float) -> Iterator[pa.RecordBatch]:
    group = pa.Table.from_batches(held).combine_chunks()
    if group.num_rows < 2:
        return
    cell, low, high = (group.column(k)[0].as_py() for k in range(3))
    block, rep, copies, home = (group.column(n).to_numpy() for n in ("block", "rep", "copies", "home"))
    factor = group.column("factor").to_numpy()
    values = np.stack(group.column("v").to_numpy()).astype(np.float64)
    units = _units(values)
    turned = units.astype(np.float32) @ turn.T
    packed = np.frombuffer(b"".join(group.column("code").to_pylist()), np.uint8).reshape(len(rep), -1)
    signs = (np.unpackbits(packed, axis=1).astype(np.float32) * 2 - 1) / math.sqrt(turn.shape[0])
    bound = np.sqrt(np.maximum(0.0, 1 - factor**2)) / factor * CONFIDENCE / math.sqrt(max(1, turn.shape[0] - 1))
    lives = home == cell
    # Data: the cell's own vectors of the high block. Queries: those of the low block, and the visitors.
    data = np.flatnonzero(lives & (block == high))
    asks = np.flatnonzero((lives & (block == low)) | ~lives)
    if not len(data) or not len(asks):
        return
    visited = np.frombuffer(b"".join(group.column("visited").to_pylist()), np.uint8).reshape(len(rep), -1)
    links = np.zeros(len(rep), np.int64)
    label = np.arange(len(rep))
    step = max(1, TILE // len(data))
    for at in range(0, len(asks), step):
        some = asks[at : at + step]
        estimate = turned[some] @ signs[data].T / factor[data]
        q, x = np.nonzero(estimate + bound[data] >= cosine)
        q, x = some[q], data[x]
        # Each pair of the cell's own block once.
        keep = ~lives[q] | (low != high) | (q < x)
        q, x = q[keep], x[keep]
        near = np.concatenate(
            [
                np.einsum("ij,ij->i", units[q[i : i + TILE // 16]], units[x[i : i + TILE // 16]])
                for i in range(0, len(q), TILE // 16)
            ]
            or [np.empty(0)]
        )
        hit = near >= cosine
        q, x = q[hit], x[hit]
        # A pair of two cells that visit each other is counted in the lower cell.
        away = np.flatnonzero(~lives[q])
        if len(away):
            there = home[q[away]]
            twice = (there < cell) & (visited[x[away], there >> 3] >> (7 - (there & 7)) & 1 == 1)
            keep = np.ones(len(q), bool)
            keep[away[twice]] = False
            q, x = q[keep], x[keep]
        links += np.bincount(q, weights=copies[x], minlength=len(rep)).astype(np.int64)
        links += np.bincount(x, weights=copies[q], minlength=len(rep)).astype(np.int64)
        label = merge_labels(label, q, x)
    some = np.flatnonzero(links)
    star = np.flatnonzero(label != np.arange(len(rep)))
    a = np.concatenate([rep[some], rep[star]])
    b = np.concatenate([rep[some], rep[label[star]]])
    n = np.concatenate([links[some], np.zeros(len(star), np.int64)])
    if len(a):
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n)], names=["a", "b", "n"])
