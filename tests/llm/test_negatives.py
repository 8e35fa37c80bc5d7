"""Hard-negative mining against a brute-force statement of its contract, and the bounds by themselves."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperflow.llm import hard_negatives as hn

RNG = random.Random(12)
SCHEMA = "vec_id long, embedding array<double>, label long, id long, q string, slot int"


def vector(near=None, n=70, spread=0.3):
    return [(near[k] if near else 0.2) + RNG.gauss(0, spread) for k in range(n)]


def rows():
    centres = [vector(spread=0.6) for _ in range(4)]
    out = [(k, vector(centres[k % 4] if k % 3 else None), k % 5) for k in range(400)]
    out += [(400 + k, out[k][1], (k + k % 2) % 5) for k in range(30)]  # ties
    out += [(3, out[3][1], 3), (3, out[3][1], 3), (50, out[50][1], 0)]  # repeated rows
    out += [(450, None, 1), (451, vector(), None), (452, [1.0, None], 1), (453, [float("nan")] * 70, 1), (None, vector(), 1),
            (454, [float("inf")] * 70, 1), (455, [], 2), (500, [], 2), (456, [0.5] * 9, 2), (550, [0.5] * 100, 3), (-50, vector(), 1),
            (600, [0.0] * 70, 0), (457, vector(), 77), (650, vector(), 78)]
    return [(*r, 1, "q", 2) for r in out]


ROWS = rows()


def brute(data, positives=5, negatives=3):
    own = {}
    for i, v, label, *_ in data:
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v):
            own[i] = min(own.get(i, (label, v)), (label, v))
    q = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in own.items()}
    out = set()
    for a in (i for i in q if i % 50 == 0):
        label, x = q[a]
        scores = sorted((-sum(s * t for s, t in zip(x, y)), i, other) for i, (other, y) in q.items() if i != a)
        for s, p, _ in [r for r in scores if r[2] == label][:positives]:
            fit = [r for r in scores if r[2] != label and -50 * s <= -100 * r[0] <= -95 * s][:negatives]
            out |= {(a, p, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(fit)}
    return out


@pytest.mark.parametrize("tile,steps", [(4096, (256, 2048)), (60, (7, 50))])
def test_same_as_brute_force(spark, monkeypatch, tile, steps):
    monkeypatch.setattr(hn, "TILE", tile)
    monkeypatch.setattr(hn, "_STEP_ANCHORS", steps[0])
    monkeypatch.setattr(hn, "_STEP_ROWS", steps[1])
    df = hn.hard_negatives(spark.createDataFrame(ROWS, SCHEMA), F.col("vec_id") % 50 == 0)
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = [tuple(r) for r in df.collect()]
    want = brute(ROWS)
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 50


def test_empty(spark):
    vectors = spark.createDataFrame([], SCHEMA)
    assert hn.hard_negatives(vectors, F.col("vec_id") % 50 == 0).count() == 0
    assert hn.hard_negatives(spark.createDataFrame(ROWS, SCHEMA), F.lit(None).cast("boolean")).count() == 0


def block(rows, labels=None):
    q = np.array(rows, np.int64)
    out = object.__new__(hn.Block)
    out.ids, out.labels, out.q = np.arange(len(q)), np.array(labels or [0] * len(q)), q
    out.summary, out.most = hn.summarize(q), float(np.abs(q).max())
    return out


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(1)
    a, b = block(rng.integers(-300, 300, (20, 64))), block(rng.integers(-300, 300, (30, 64)) + 40)
    true, last = a.q @ b.q.T, None
    for level in hn.levels(64):
        low, high = hn.bounds(a, b, level)
        assert (low <= true).all() and (true <= high).all()
        if last is not None:
            assert (high - low).mean() < last
        last = (high - low).mean()


def test_bounds_spare_exact_scores():
    """Where segments tell vectors apart, most pairs never reach the exact score."""
    rng = np.random.default_rng(2)
    centres = np.repeat(rng.integers(-400, 400, (8, 16)), 4, axis=1)
    rows = centres[rng.integers(0, 8, 500)] + rng.integers(-20, 20, (500, 64))
    a, b, scored = block(rows[:20]), block(rows), []
    b.ids = b.ids + 1000
    real = hn.exact
    hn.exact = lambda x, y, at, to: scored.append(len(at)) or real(x, y, at, to)
    try:
        (at, to, scores), = hn.positives_of(a, b, 5)
    finally:
        hn.exact = real
    true = a.q @ b.q.T
    assert sorted(scores.tolist()) == sorted(np.sort(true, axis=1)[:, -5:].ravel().tolist())
    assert sum(scored) < 0.4 * true.size


def test_large_components():
    a, b = block([[1 << 40, 3]]), block([[1 << 30, 5], [-(1 << 40), 1]])
    assert hn.exact(a, b, np.array([0, 0]), np.array([0, 1])).tolist() == [(1 << 63) - 1, -(1 << 63)]
    a, b = block([[(1 << 31) + 1, 3]]), block([[(1 << 30) + 1, 5]])
    assert hn.exact(a, b, np.array([0]), np.array([0])).tolist() == [((1 << 31) + 1) * ((1 << 30) + 1) + 15]
