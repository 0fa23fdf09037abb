"""Whitening: the divide-and-conquer against LAPACK, and results against plain sums."""

import math

import numpy as np
import pytest

from monthstar.llm import QUERIES, whitening

RNG = np.random.default_rng(11)


def turned(values):
    q = np.linalg.qr(RNG.standard_normal((len(values), len(values))))[0]
    return (q * np.asarray(values, float)) @ q.T


@pytest.mark.parametrize(
    "matrix",
    [
        np.array([[3.0]]),
        np.diag(np.arange(9.0)),
        np.eye(5),
        turned(np.tile([1.0, 2, 3, 4], 6)),
        turned(2.0 ** -np.arange(40)),
        turned([5, 4, 3, *[0] * 20]),
        turned(1 + 1e-9 * np.arange(30)),
        turned([*range(8), *(-v for v in range(8))]),
        turned([1e6, *[1] * 20]),
        np.cov(RNG.standard_normal((64, 300))),
    ],
)
def test_components_equal_lapack(matrix):
    matrix = (matrix + matrix.T) / 2
    k = min(16, len(matrix))
    values, vectors = whitening.principal(matrix, k)
    size = np.linalg.norm(matrix)
    assert np.abs(values - np.linalg.eigvalsh(matrix)[::-1][:k]).max() < 1e-14 * len(matrix) * size
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13
    assert np.linalg.norm(matrix @ vectors - vectors * values) < 1e-13 * size


def test_polar_factor_of_an_ill_conditioned_matrix():
    a = turned([1, -1e-3, 1e-9, -1e-12])
    u = whitening.polar(a)
    assert np.abs(u @ u - np.eye(4)).max() < 1e-13
    assert np.abs(u @ a - a @ u).max() < 1e-13


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int, n int")


def cloud(n=60, d=6):
    points = RNG.standard_normal((n, d)) * 2.0 ** -np.arange(d) + 3
    return [(i, row.tolist(), 1, 1) for i, row in enumerate(points)]


def test_rows_against_plain_sums(spark):
    rows = cloud()
    rows += [rows[3], rows[3], (None, rows[4][1], 1, 1), (200, [0.0] * 6, 1, 1)]
    out = whitening.whitened(frame(spark, rows)).collect()
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in row[1]] for row in rows])
    n, sums = len(x), x.sum(axis=0)
    assert len(out) == 6 * n and {r["n"] for r in out} == {n}
    exact = sorted(sum(int(v) ** 2 for v in n * line - sums) for line in x for _ in range(6))
    assert sorted(int(r["deviation"]) for r in out) == exact
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    plain = np.abs(centred @ vectors / np.sqrt(values))
    for c in range(6):
        mine = [r for r in out if r["component"] == c + 1]
        assert np.allclose(sorted(abs(r["whitened"]) for r in mine), sorted(plain[:, c]), atol=1e-9)
        assert all(abs(r["explained"] / (values[c] / values.sum()) - 1) < 1e-9 for r in mine)
        assert abs(np.mean([r["whitened"] ** 2 for r in mine]) - 1) < 1e-9
    assert len({r["identity_error"] for r in out}) == 1 and out[0]["identity_error"] < 1e-9
    assert sum(r["vec_id"] is None for r in out) == 6


def test_unusable_vectors_are_left_out(spark):
    good = cloud()
    bad = [
        (900, None, 1, 1),
        (901, [], 1, 1),
        (902, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1, 1),
        (903, [math.nan] * 6, 1, 1),
        (904, [math.inf] + [0.0] * 5, 1, 1),
        (905, [1e300] + [0.0] * 5, 1, 1),
    ]
    whole = whitening.whitened(frame(spark, good + bad)).collect()
    alone = whitening.whitened(frame(spark, good)).collect()
    value = {(r["vec_id"], r["component"]): r["whitened"] for r in alone}
    assert {(r["vec_id"], r["component"]) for r in whole} == set(value) and len(whole) == len(value)
    assert all(abs(r["whitened"] - value[r["vec_id"], r["component"]]) < 1e-9 for r in whole)


def test_lengths_are_whitened_apart_and_flat_tables_have_no_row(spark):
    long, short = cloud(), [(500 + i, [float(i), float(i * i)], 1, 1) for i in range(9)]
    out = whitening.whitened(frame(spark, long + short)).collect()
    assert {r["n"] for r in out if r["vec_id"] >= 500} == {9}
    assert {r["n"] for r in out if r["vec_id"] < 500} == {60}
    assert whitening.whitened(frame(spark, [])).collect() == []
    same = [(i, [0.5, 0.25], 1, 1) for i in range(20)]
    assert whitening.whitened(frame(spark, same)).collect() == []


def test_a_flat_direction_is_no_component(spark):
    rows = [(i, [i / 7, 2 * i / 7, 1.0, (i * i % 5) / 3], 1, 1) for i in range(50)]
    rows = [(i, [math.floor(64 * c) / 64 for c in v], a, b) for i, v, a, b in rows]
    out = whitening.whitened(frame(spark, rows)).collect()
    assert {r["component"] for r in out} == {1, 2, 3}
    assert out[0]["identity_error"] < 1e-4


def test_deviation_outgrows_a_long(spark):
    rows = [(i, [2.0**30 * (i % 2)] * 2, 1, 1) for i in range(10)]
    out = whitening.whitened(frame(spark, rows))
    assert int(out.first()["deviation"]) == 2 * (5 * 2**36) ** 2
    assert out.select(whitening.as_long("deviation").alias("v")).first()["v"] is None


def test_query(spark):
    out = QUERIES["op11_whitening"](spark, "/root/testdata/sf0.001")
    assert dict(out.dtypes)["deviation"] == "bigint"
    rows = out.collect()
    assert {r["component"] for r in rows} == set(range(1, 33))
    assert rows[0]["identity_error"] < 1e-4
