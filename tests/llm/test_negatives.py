"""Hard negatives against plain versions; the tree loses no row a window holds."""

import math

import numpy as np
import pytest

from hubloom.llm import negatives
from hubloom.llm.negatives import Tree, _flat, _raised, hard_negatives
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, every=5, k=5):
    """{(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)}"""
    good = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows
            if i is not None and y is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for a, v, label in good:
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w, strict=False)), i, y)
                        for i, w, y in good if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:k]:
            inside = [(-t, i) for t, i, y in scored if y != label and 80 * -s <= 100 * -t <= 100 * -s]
            out |= {(a, p, r + 1, i, -s, t) for r, (t, i) in enumerate(inside[:k])}
    return out


def got(frame, every=5, **more):
    found = hard_negatives(frame, F.col("vec_id") % every == 0, **more).collect()
    assert len(set(found)) == len(found)
    return {tuple(r) for r in found}


@pytest.fixture
def small(monkeypatch):
    """Many leaves, pages and groups on few rows."""
    for name, value in dict(SAMPLED=4, PAGE=16, GROUP=7, LEAF=4, FITTED=100).items():
        monkeypatch.setattr(negatives, name, value)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain(spark, small, seed):
    draw = np.random.default_rng(seed)
    centers = draw.normal(size=(6, 8))
    rows = [(i, (centers[i % 6] + draw.normal(size=8) * 0.4).tolist(), int(draw.integers(3)))
            for i in range(220)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_copies_hold_a_third_of_all_rows(spark, small):
    draw = np.random.default_rng(3)
    rows = [(i, [0.5, 0.25, 0.125, 0.0] if i % 3 == 0 else draw.normal(size=4).tolist(),
             int(draw.integers(2))) for i in range(150)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_awkward_rows(spark, small):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.5], 1), (5, [0.9, 0.5, 0.1], 1), (10, [], 1), (15, None, 1),
            (20, [1.0, None], 1), (25, [1.0, inf], 2), (30, [nan], 2), (None, [1.0, 1.0], 2),
            (35, [1.0, 0.5], None), (1, [1.0, 0.45], 2), (2, [0.95, 0.5], 2), (3, [0.95, 0.5], 2),
            (4, [-1.0, -0.5], 1), (40, [0.0, 0.0], 2), (45, [-0.3, 0.2], 3)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 AS leaf", "2 AS page", "3 AS `group`", "4 AS least", "5 AS Score", "map(1, 2) AS m",
        "6 AS asked", "7 AS vector")
    assert got(frame) == plain(rows)


def test_repeated_ids_are_candidates_each(spark):
    rows = [(0, [1.0], 1), (1, [0.75], 1), (2, [0.75], 2), (2, [0.75], 2), (2, [0.625], 2)]
    found = hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0).collect()
    assert sorted((r.rank, r.negative_id, r.negative_score) for r in found) == [
        (1, 2, 256 * 192), (2, 2, 256 * 192), (3, 2, 256 * 160)]


@pytest.mark.parametrize("rows", [[], [(0, [1.0], 1)], [(1, [1.0], 1), (2, [1.0], 2)],
                                  [(0, [], 1), (1, [], 1), (2, [], 2)]])
def test_tiny_tables(spark, rows):
    assert got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_numbers_beyond_exact_doubles(spark, small):
    rows = [(i, [float(2 ** 20 + i), float(3 ** 12 * i % 977)], i % 2) for i in range(60)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_parameters(spark):
    rows = [(i, [math.sin(i), math.cos(i)], i % 4) for i in range(40)]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = got(frame, positives=2, negatives=1, percent=100)
    assert all(r[2] == 1 and r[4] == r[5] for r in found)


def test_the_tree_meets_every_row_in_a_window_and_eliminates_others():
    draw = np.random.default_rng(5)
    rows = np.rint(draw.normal(size=(12, 6))[draw.integers(12, size=3000)] * 200
                   + draw.normal(size=(3000, 6)) * 10)
    radius = float(np.sqrt((rows * rows).sum(axis=1).max()))
    points = _raised(rows, radius)
    tree = Tree(points[:500], radius, 16, 3)
    leaves = tree.leaves_of(points, learn=True)
    scores = rows[:100] @ rows.T
    most = np.sort(scores, axis=1)[:, -20]
    least = np.ceil(0.8 * most)
    met = tree.met(_flat(rows[:100]), least, most)
    inside = (scores >= least[:, None]) & (scores <= most[:, None])
    for q in range(100):
        assert met[q][leaves[inside[q]]].all()
    assert met.mean() < 0.6 and tree.n_leaves > 30
