import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from logloom.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, row string, id string, band string, anchor string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "x", "x", "x") for i, v, label in rows], SCHEMA).repartition(4)


def plain(rows, is_anchor, low=50, high=95, n_positives=5, n_negatives=3):
    """All pairs, in whole numbers."""
    known = []
    for i, v, label in rows:
        if v is not None and label is not None and all(c is not None and math.isfinite(c) for c in v):
            known.append((i, [math.floor(256 * c) for c in v], label))
    out = []
    for a, (i, q, own) in enumerate(known):
        if i is None or not is_anchor(i):
            continue
        scored = [
            (-sum(x * y for x, y in zip(q, v)), j is None, j or 0, label)
            for b, (j, v, label) in enumerate(known)
            if b != a and len(v) == len(q)
        ]
        first = sorted(s for s in scored if s[3] == own)[:n_positives]
        others = sorted(s for s in scored if s[3] != own)
        for score, none, j, _ in first:
            fits = [s for s in others if low * -score <= 100 * -s[0] <= high * -score][:n_negatives]
            out += [(i, None if none else j, r, None if s[1] else s[2], -score, -s[0]) for r, s in enumerate(fits, 1)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def drawn(n, d, seed, spread=1.0, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, d))
    v = centres[rng.integers(0, 8, n)] + spread * rng.normal(size=(n, d))
    v *= np.exp(rng.normal(size=(n, 1))) / np.linalg.norm(v, axis=1, keepdims=True)
    return [(i, v[i].tolist(), int(rng.integers(0, labels))) for i in range(n)]


@pytest.mark.parametrize("spread", [0.1, 1.0])
def test_equals_all_pairs(spark, monkeypatch, spread):
    # Blocks and buckets so small that there are many of each.
    for name, value in {"ROWS": 64, "ANCHORS": 8}.items():
        monkeypatch.setattr(negatives, name, value)
    rows = drawn(400, 12, 5, spread)
    got = negatives.mine(frame(spark, rows), F.col("vec_id") % 10 == 0)
    expected = plain(rows, lambda i: i % 10 == 0)
    assert found(got) == expected and len(expected) > 100


def test_odd_rows_ties_and_repeats(spark):
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [0.9, 0.0], 2), (3, [0.9, 0.0], 2), (4, [0.9, 0.0], 2),
        (5, [0.9, 0.0], None), (6, None, 2), (7, [0.9, None], 2), (8, [math.nan, 0.0], 2), (9, [math.inf, 0.0], 2),
        (10, [0.0, 0.0], 1), (11, [0.0, 0.0], 2), (12, [-1.0, 0.0], 1), (13, [1.0], 1), (14, [], 1), (20, [0.9, 1e9], 3), (30, [0.6, 0.0], 2),
    ]
    got = negatives.mine(frame(spark, rows), F.col("vec_id") % 10 == 0)
    expected = plain(rows, lambda i: i % 10 == 0)
    assert found(got) == expected and len(expected) > 10
    assert negatives.mine(frame(spark, rows).limit(0), F.lit(True)).count() == 0
    assert negatives.mine(frame(spark, rows), F.lit(False)).count() == 0


def test_a_hot_label_and_one_vector_in_a_third_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 50)
    rows = drawn(300, 8, 9)
    rows += [(300 + i, rows[7][1], 1) for i in range(200)]
    got = negatives.mine(frame(spark, rows), F.col("vec_id") % 25 == 0)
    assert found(got) == plain(rows, lambda i: i % 25 == 0)


def test_products_beyond_doubles_are_exact():
    q = np.array([[(1 << 40) + 1, 3], [5, -(1 << 41)]])
    x = np.array([[(1 << 20) + 7, 1], [2, 9], [1 << 20, 0]])
    a, _, r, score, _ = negatives.search(
        q, x, np.arange(3), np.zeros(3, bool), lambda i, j: np.zeros(np.broadcast(i, j).shape, bool), np.full((2, 1), -np.inf), np.full((2, 1), np.inf), 3
    )
    assert sorted(zip(a, r, score)) == sorted((i, j, sum(int(s) * int(t) for s, t in zip(q[i], x[j]))) for i in range(2) for j in range(3))


def test_coordinates_prune_without_loss(monkeypatch):
    """Vectors around few centres: a high bound leaves few candidates, and none that counts is lost."""
    monkeypatch.setattr(negatives, "BUCKET", 128)
    v = np.floor(256 * np.array([r[1] for r in drawn(2000, 16, 2, 0.05)])).astype(np.int64)
    q = v[::50]
    scores = q @ v.T
    low = np.sort(scores, 1)[:, -20, None].astype(float)
    none = np.zeros(len(v), bool)
    a, _, r, score, verified = negatives.search(
        q, v, np.arange(len(v)), none, lambda i, j: np.zeros(np.broadcast(i, j).shape, bool), low, np.full(low.shape, np.inf), 3
    )
    for i in range(len(q)):
        best = np.lexsort((np.arange(len(v)), -scores[i]))[:3]
        assert sorted(r[a == i]) == sorted(best)
    assert verified < 0.2 * scores.size
