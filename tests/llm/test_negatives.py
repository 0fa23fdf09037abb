"""Hard negatives against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthstar.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<double>, row int, rank int"


def plain(rows, anchor):
    """All results by brute force; rows ``(id, label, vector)`` whose ids differ."""
    usable = [
        (i, label, [math.floor(256 * c) for c in v])
        for i, label, v in rows
        if i is not None and label is not None and v and all(c is not None and math.isfinite(c) for c in v)
    ]
    out = []
    for i, label, v in usable:
        if not anchor(i):
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in usable if j != i and len(w) == len(v)
        )
        for s, j, other in [x for x in scored if x[2] == label][:5]:
            inside = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s]
            out += [(i, j, k + 1, x[1], -s, -x[0]) for k, x in enumerate(inside[:3])]
    return sorted(out)


def mined(spark, rows, anchor="vec_id % 5 = 0"):
    table = spark.createDataFrame([(*row, 1, 2) for row in rows], SCHEMA)
    return sorted(map(tuple, negatives.hard_negatives(table, F.expr(anchor)).collect()))


def cloud(n, d, labels, seed=3, spread=0.5):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((labels, d))
    return [
        (i, i % labels, (centres[i % labels] * 0.5 + 0.7 + spread * rng.standard_normal(d)).tolist()) for i in range(n)
    ]


@pytest.mark.parametrize("d", [1, 3, 8, 19])
def test_equals_all_pairs(spark, d):
    rows = cloud(150, d, 4)
    want = plain(rows, lambda i: i % 5 == 0)
    assert want and mined(spark, rows) == want


def test_small_blocks_and_chunks_change_nothing(spark, monkeypatch):
    rows = cloud(160, 11, 3)
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 7)
    monkeypatch.setattr(negatives, "CHUNK_ENTRIES", 100)
    assert mined(spark, rows) == plain(rows, lambda i: i % 5 == 0)


def test_ties_go_to_smaller_ids(spark):
    rows = [(i, i % 2, [1.0, 0.5] if i % 2 == 0 else [0.8, 0.4]) for i in range(60)]
    found = mined(spark, rows)
    assert found == plain(rows, lambda i: i % 5 == 0)
    assert {row[3] for row in found} <= {1, 3, 5, 0, 2, 4}


def test_rows_that_take_no_part(spark):
    rows = cloud(80, 4, 3)
    odd = [
        (None, 1, [1.0] * 4),
        (100, None, [1.0] * 4),
        (105, 1, None),
        (110, 1, []),
        (115, 1, [1.0, None, 1.0, 1.0]),
        (120, 1, [math.nan] * 4),
        (125, 1, [math.inf] * 4),
        (130, 1, [1.0] * 3),
    ]
    assert mined(spark, rows + odd) == plain(rows + odd, lambda i: i % 5 == 0)
    assert mined(spark, []) == []
    assert mined(spark, rows, "cast(null as boolean)") == []
    assert mined(spark, [(0, 1, [1.0]), (5, 1, [1.0])]) == []


def test_scores_beyond_doubles_are_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, i % 3, (60_000 + rng.random(9) * 5000 - 2500 * (i % 3)).tolist()) for i in range(60)]
    want = plain(rows, lambda i: i % 5 == 0)
    assert want and max(row[4] for row in want) > 2**50
    assert mined(spark, rows) == want


def test_repeated_rows_are_rows_of_their_own(spark):
    rows = [(0, 1, [1.0, 1.0])] * 3 + [(1, 2, [0.8, 0.8])] * 2
    found = mined(spark, rows)
    # Each of three anchors has the two other copies as positives, each of these both negatives.
    assert len(found) == 3 * 2 * 2
    assert {row[:2] + row[3:4] for row in found} == {(0, 0, 1)}


def test_bounds_hold_at_every_step():
    rng = np.random.default_rng(9)
    x = rng.integers(-300, 300, (20, 50)).astype(float)
    block = negatives.Block(np.arange(50), list(range(50)), np.zeros(50), x, x.min(axis=1), x.max(axis=1))
    anchor = negatives.Anchor(-1, -1, 0, rng.integers(-300, 300, 20).astype(float))
    exact = np.zeros(50)
    exact[:] = anchor.vector @ x[anchor.order]

    def keep(rows, least, most):
        assert (least <= exact[rows]).all() and (exact[rows] <= most).all()
        return rows % 3 != 1

    rows, score = negatives.scan(anchor, block, np.ones(50, bool), keep)
    assert (score == exact[rows]).all() and len(rows) == 33
