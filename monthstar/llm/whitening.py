"""Whitening of vectors by QDWH spectral divide-and-conquer.

Entries become whole numbers. Their count, sums and centred covariance are gathered on
the cluster; only the covariance, whose size depends on the dimensions alone, comes to
the driver. There the polar factor of the covariance less a shift (by QR-based,
dynamically weighted Halley steps) gives the projector on the eigenvectors above the
shift. It splits the space in two, and the parts are split again until each is a
single component. The components are broadcast, and every vector is projected where
it lies.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthstar.llm.tables import kind_of, mapped

#: An entry ``c`` becomes ``floor(SCALE * c) + OFFSET``.
SCALE, OFFSET = 64, 1_000_000
#: Components that are returned at most.
COMPONENTS = 32
#: Entries at and beyond this have no place in a long after scaling.
LARGEST = 2.0**56
#: Share of the largest variance below which a component is rounding, not data.
RANK = 1e-10
#: Vectors that are Python matrices at the same time.
SLICE = 1024
_EPS = np.finfo(np.float64).eps


@dataclass(frozen=True)
class Fit:
    """Count, exact sums, components (columns, falling variance) and their variances for one vector length."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    trace: float


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix."""
    eye = np.eye(len(a))
    x = a / np.linalg.norm(a)
    low = _EPS / 2
    for _ in range(20):
        l2 = low * low
        step = (4 * (1 - l2) / l2**2) ** (1 / 3)
        root = math.sqrt(1 + step)
        wa = root + math.sqrt(8 - 4 * step + 8 * (2 - l2) / (l2 * root)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q = np.linalg.qr(np.vstack([math.sqrt(wc) * x, eye]))[0]
        moved = (wb / wc) * x + (wa - wb / wc) / math.sqrt(wc) * (q[: len(a)] @ q[len(a) :].T)
        moved = (moved + moved.T) / 2
        change = np.linalg.norm(moved - x)
        x, low = moved, min(1.0, low * (wa + wb * l2) / (1 + wc * l2))
        if 1 - low < 10 * _EPS and change < 1e-10:
            break
    return x


def split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the eigenvectors above some shift, and of the others; both have columns.

    The median of the diagonal parts most matrices evenly. A shift at the mean, moved
    by less than the deviation over the root of the size, always lies between two
    eigenvalues; several are tried because one of them may be an eigenvalue.
    """
    k = len(a)
    mean = np.trace(a) / k
    width = math.sqrt(max(0.0, np.sum(a * a) / k - mean * mean))
    size = np.linalg.norm(a - mean * np.eye(k))
    shifts = [float(np.median(np.diag(a)))]
    shifts += [mean + part * width / math.sqrt(k) for part in (0.0, 0.37, -0.37, 0.61, -0.61, 0.83, -0.83)]
    start = np.random.default_rng(k).standard_normal((k, k))
    best = None
    for shift in shifts:
        projector = (polar(a - shift * np.eye(k)) + np.eye(k)) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < k:
            continue
        basis = start
        for _ in range(2):
            above = projector @ basis[:, :rank]
            below = basis[:, rank:] - projector @ basis[:, rank:]
            basis = np.linalg.qr(np.hstack([above, below]))[0]
        upper, lower = basis[:, :rank], basis[:, rank:]
        left = np.linalg.norm(lower.T @ a @ upper)
        if best is None or left < best[0]:
            best = left, upper, lower
        if left <= 8 * k * _EPS * size:
            break
    if best is None:
        raise ArithmeticError("no shift parts the matrix")
    return best[1], best[2]


def principal(covariance: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns.

    Equal eigenvalues share any orthonormal basis. The sign makes the entry of
    largest size positive.
    """
    d = len(covariance)
    size = np.linalg.norm(covariance)
    parts = [(np.eye(d), covariance)]
    found: list[np.ndarray] = []
    while parts and len(found) < wanted:
        basis, a = parts.pop()
        k = len(a)
        if k == 1 or np.linalg.norm(a - np.trace(a) / k * np.eye(k)) <= 2 * k * _EPS * size:
            found += list(basis.T)
            continue
        upper, lower = split(a)
        for half in (lower, upper):
            inner = half.T @ a @ half
            parts.append((basis @ half, (inner + inner.T) / 2))
    vectors = np.array(found).T
    vectors *= np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(vectors.shape[1])])
    values = np.einsum("ij,ij->j", vectors, covariance @ vectors)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], vectors[:, order]


def scaled(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, x array<long>)`` of the vectors that can be used."""
    v = F.col("v")
    usable = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST)))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    return rows.where(v.isNotNull() & (F.size(v) > 0) & usable).select(
        "id", F.transform(v, lambda c: F.floor(c * SCALE).cast("long") + OFFSET).alias("x")
    )


def _matrices(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and whole-number matrices of vectors of one length, a bounded slice at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            ids, lists = part.column(0), part.column(1)
            lengths = np.diff(lists.offsets.to_numpy())
            flat, first = lists.flatten().to_numpy(), np.r_[0, np.cumsum(lengths)]
            for d in np.unique(lengths):
                rows = np.flatnonzero(lengths == d)
                yield ids.take(pa.array(rows)), flat[first[rows][:, None] + np.arange(d)]


def _offsets(x: np.ndarray, n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """``y`` and ``t`` with ``n * y - t = n * x - sums``, both small: entries less the rounded mean."""
    middle = [s // n for s in sums]
    return x - np.array(middle, np.int64), np.array([s - n * m for s, m in zip(sums, middle)])


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    y, t = _offsets(x, n, sums)
    return y - np.array([float(v) / n for v in t])


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int]:
    """The exact sum of ``(n * x - sums) ** 2`` of every row."""
    y, t = _offsets(x, n, sums)
    most = max(int(np.abs(y).max()), 1) * max(int(np.abs(y).max()), max(map(abs, t.tolist())), 1)
    if most * x.shape[1] >= 1 << 62:
        y, t = y.astype(object), t.astype(object)
    squares, mixed = (y * y).sum(axis=1).tolist(), (y * t).sum(axis=1).tolist()
    rest = sum(v * v for v in t.tolist())
    return [n * n * a - 2 * n * b + rest for a, b in zip(squares, mixed)]


def _totals(x: DataFrame) -> dict[int, tuple[int, tuple[int, ...]]]:
    """Number of vectors and exact sum of each dimension, by length."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for _, values in _matrices(batches):
            safe = int(np.abs(values).max()) * len(values) < 1 << 62
            sums = [int(s) for s in (values if safe else values.astype(object)).sum(axis=0)]
            kept = found.setdefault(values.shape[1], [0, [0] * values.shape[1]])
            kept[0] += len(values)
            kept[1] = [a + b for a, b in zip(kept[1], sums)]
        for d, (n, sums) in found.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([d] * d, pa.int32()),
                    pa.array(range(d), pa.int32()),
                    pa.array([n] * d, pa.int64()),
                    pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0)),
                ],
                names=["d", "i", "n", "s"],
            )

    parts = x.select("id", "x").transform(mapped, run, "d int, i int, n long, s decimal(38,0)")
    totals = parts.groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    out: dict[int, tuple[int, dict[int, int]]] = {}
    for row in totals.collect():
        out.setdefault(row["d"], (row["n"], {}))[1][row["i"]] = int(row["s"])
    return {d: (n, tuple(sums[i] for i in range(d))) for d, (n, sums) in out.items()}


def _products(x: DataFrame, sent, points) -> dict[int, np.ndarray]:
    """The sum over vectors of the outer product of ``points(values, sent[length])`` with itself, by length.

    Every task adds up its own products; the sums of the tasks meet entry by entry.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for _, values in _matrices(batches):
            d = values.shape[1]
            at = points(values, sent.value[d])
            found[d] = found.get(d, 0) + at.T @ at
        for d, product in found.items():
            for i, line in enumerate(product):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d], pa.int32()), pa.array([i], pa.int32()), pa.array([line], pa.list_(pa.float64()))],
                    names=["d", "i", "line"],
                )

    parts = x.select("id", "x").transform(mapped, run, "d int, i int, line array<double>")
    entries = parts.select("d", "i", F.posexplode("line").alias("j", "value")).where("j >= i")
    sums = entries.groupBy("d", "i", "j").agg(F.sum("value").alias("value")).toArrow()
    d, i, j, value = (column.to_numpy() for column in sums.columns)
    out = {}
    for length in np.unique(d):
        mine = d == length
        product = np.zeros((int(j[mine].max()) + 1,) * 2)
        product[i[mine], j[mine]] = value[mine]
        product[j[mine], i[mine]] = value[mine]
        out[int(length)] = product
    return out


def _fits(x: DataFrame, wanted: int) -> dict[int, Fit]:
    totals = _totals(x)
    sent = x.sparkSession.sparkContext.broadcast(totals)
    fits = {}
    for d, product in _products(x, sent, lambda values, total: _centred(values, *total)).items():
        n, sums = totals[d]
        covariance = product / n
        values, vectors = np.empty(0), np.empty((d, 0))
        if np.trace(covariance) > 0:
            values, vectors = principal(covariance, min(wanted, d))
            kept = values > RANK * values[0]
            values, vectors = values[kept], vectors[:, kept]
        fits[d] = Fit(n, sums, vectors, values, float(np.trace(covariance)))
    return fits


def _whitened(values: np.ndarray, fit: Fit) -> np.ndarray:
    return _centred(values, fit.n, fit.sums) @ (fit.components / np.sqrt(fit.variances))


def _with_one(values: np.ndarray, fit: Fit) -> np.ndarray:
    return np.hstack([np.ones((len(values), 1)), _whitened(values, fit)])


def identity_errors(x: DataFrame, sent, fits: dict[int, Fit]) -> dict[int, float]:
    """The largest absolute entry of the whitened vectors' covariance less the identity, by length, as measured."""
    out = {}
    for d, product in _products(x, sent, _with_one).items():
        mean = product[0, 1:] / fits[d].n
        left = product[1:, 1:] / fits[d].n - np.outer(mean, mean) - np.eye(len(mean))
        out[d] = float(np.abs(left).max()) if left.size else 0.0
    return out


def whitened(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """A row for every usable vector and component: ``(id, component, n, deviation, whitened, explained, identity_error)``.

    Components are numbered from 1 by falling variance. ``deviation`` is a
    decimal(38,0), since it outgrows a long with the square of the rows.

    Vectors that are null or empty, or hold a null or non-finite entry or one of
    2^56 and more, are left out. Vectors of each length are whitened among
    themselves. Components whose variance is below ``RANK`` of the largest are
    left out, so a table of equal vectors, like an empty one, gives no row.
    Equal variances may share any basis. Repeated rows and null ids count and
    keep their rows; other columns are not read.
    """
    x = scaled(vectors, id_col, vec_col)
    fits = _fits(x, components)
    context = x.sparkSession.sparkContext
    sent = context.broadcast(fits)
    errors = context.broadcast(identity_errors(x, sent, fits))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, values in _matrices(batches):
            d = values.shape[1]
            fit = sent.value[d]
            rows, k = len(values), len(fit.variances)
            if not k:
                continue
            each = pa.array(np.repeat(np.arange(rows), k))
            exact = pa.array([Decimal(v) for v in deviations(values, fit.n, fit.sums)], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(each),
                    pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                    pa.array(np.full(rows * k, fit.n), pa.int64()),
                    exact.take(each),
                    pa.array(_whitened(values, fit).ravel()),
                    pa.array(np.tile(fit.variances / fit.trace, rows)),
                    pa.array(np.full(rows * k, errors.value[d])),
                ],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return x.transform(
        mapped,
        run,
        f"`{id_col}` {kind_of(vectors, id_col)}, component int, n long, deviation decimal(38,0), whitened double, "
        "explained double, identity_error double",
    )


def as_long(deviation: str) -> Column:
    """The exact deviation as a long; null where it has outgrown one."""
    return F.col(deviation).try_cast("long")
