"""Cover trees: exact results against brute force, pruning, rounds, edge rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipwell.llm import hard_negatives as hn


def clusters(rng, n, dims=8, spread=0.02):
    centres = rng.normal(size=(12, dims))
    return np.floor(256 * (centres[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, dims))))


@pytest.mark.parametrize("kind", ["clusters", "uniform", "ties"])
def test_tree_equals_brute_force(kind):
    rng = np.random.default_rng(3)
    for n in (1, 2, 17, 900):
        points = {"clusters": clusters(rng, n), "uniform": rng.integers(-300, 300, (n, 8)), "ties": rng.integers(-1, 2, (n, 8))}[kind].astype(float)
        ids, labels = rng.permutation(n), rng.integers(0, 3, n)
        tree = hn.CoverTree.load(hn.CoverTree(points, ids, labels).dump())
        for _ in range(40):
            q = points[rng.integers(n)] if rng.random() < 0.5 else rng.integers(-300, 300, 8).astype(float)
            scores = (points @ q).astype(int)
            ends = sorted(rng.integers(scores.min() - 5, scores.max() + 6, 2).tolist())
            windows = hn.Windows([hn.LOW, ends[0]], [hn.HIGH, ends[1]], 4)
            tree.search(q, lambda x: x != 1, windows)
            for p, (low, high) in enumerate(zip(windows.low, windows.high)):
                want = sorted((-s, i) for s, i, x in zip(scores.tolist(), ids.tolist(), labels) if x != 1 and low <= s <= high)[:4]
                assert [(-s, i) for s, i in zip(windows.scores[p].tolist(), windows.ids[p].tolist())] == want


def test_radii_cover_and_searches_skip():
    rng = np.random.default_rng(4)
    points = clusters(rng, 4000)
    tree = hn.CoverTree(points, np.arange(4000), np.zeros(4000, int))
    whole, seen = np.abs(points @ points[0]).max(), 0
    for q in points[:50]:
        windows = hn.Windows([hn.LOW], [hn.HIGH], 5)
        seen += tree.search(q, lambda x: x == 0, windows)
        assert len(windows.scores[0]) == 5
    assert whole > 0 and seen < 0.5 * 50 * 4000


def test_products_beyond_doubles():
    big = np.array([[2.0**40, 1.0], [2.0**30, 3.0]])
    assert hn.products(big, np.array([2.0**20, 1.0])).tolist() == [2**60 + 1, 2**50 + 3]
    assert hn.products(big, np.array([2.0**40, 1.0])).tolist() == [hn.HIGH, hn.HIGH if 2**70 > hn.HIGH else 2**70]


def brute(rows, positives=5, negatives=3):
    """Rows (id, label, vector); anchors are every tenth id."""
    rows = [(i, x, [int(np.floor(256.0 * c)) for c in v]) for i, x, v in rows if x is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    key = lambda i: -(2**63) if i is None else i
    out = []
    for at, (i, label, v) in enumerate(rows):
        if i is None or i % 10 or rows.index((i, label, v)) < at:
            continue
        scored = [(-score(v, w), key(j), x) for k, (j, x, w) in enumerate(rows) if k != at]
        for s, j, _ in sorted(x for x in scored if x[2] == label)[:positives]:
            inside = sorted(x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s)[:negatives]
            out += [(i, j, r, n, -s, -t) for r, (t, n, _) in enumerate(inside, 1)]
    return sorted(out)


@pytest.mark.parametrize("per_round,per_tree", [(65_536, 4096), (3, 40)])
def test_mined_equals_brute_force(spark, monkeypatch, per_round, per_tree):
    monkeypatch.setattr(hn, "ROUND", per_round)
    monkeypatch.setattr(hn, "TREE_ROWS", per_tree)
    rng = random.Random(5)
    rows = [(i, rng.randrange(3), [rng.randint(-8, 9) / 8 for _ in range(6)]) for i in range(150)]
    rows += [rows[10], rows[20], rows[20], (30, 0, [1.0] * 6), (None, 1, [0.5] * 6), (None, 2, [1.0] * 6), (150, 1, []), (151, 2, [2.0] * 4), (152, 0, [2.0] * 9)]
    rows += [(160, None, [1.0] * 6), (170, 1, None), (180, 2, [1.0, None]), (190, 1, [float("nan")] * 6), (200, 1, [float("inf")] * 6)]
    schema = "vec_id long, embedding array<double>, label int, id string, anchor string, score string, part string, tree string"
    df = spark.createDataFrame([(i, v, x, *"abcde") for i, x, v in rows], schema)
    got = hn.mined(df, F.col("id") % 10 == 0)
    found = sorted((r.anchor_id, hn.LOW if r.positive_id is None else r.positive_id, r["rank"], hn.LOW if r.negative_id is None else r.negative_id, r.positive_score, r.negative_score) for r in got.collect())
    assert found == brute(rows) and len(found) > 100
    assert hn.mined(df.limit(0), F.col("id") % 10 == 0).count() == 0 and hn.mined(df, F.lit(False)).count() == 0
