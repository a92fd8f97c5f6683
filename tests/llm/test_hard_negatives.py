"""Hard negatives against all scores, and the tables against plain inner products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamiz.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank int"


def brute(rows, every, k=5, negatives=5, window=(80, 100, 100), scale=256):
    low, high, of = window
    fine = {(d, y, tuple(math.floor(scale * float(x)) for x in e)) for d, e, y in rows
            if d is not None and y is not None and e and all(x is not None and math.isfinite(x) for x in e)}
    out = []
    for d, y, v in fine:
        if d % every:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), i, z) for i, z, w in fine if i != d and len(w) == len(v)]
        for s, i, _ in sorted((x for x in scored if x[2] == y), key=lambda x: (-x[0], x[1]))[:k]:
            fit = sorted((-t, j) for t, j, z in scored if z != y and low * s <= of * t <= high * s)[:negatives]
            out += [(d, i, n + 1, j, s, -t) for n, (t, j) in enumerate(fit)]
    return sorted(out)


def run(spark, rows, every=10, **options):
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA).repartition(3)
    out = hn.mine(df, lambda i: i % every == 0, **options)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, out.collect()))


def f32(x):
    return [float(v) for v in np.asarray(x, dtype=np.float32)]


def clustered(seed, n=500, dim=20, labels=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(labels, dim)) * 0.2
    label = rng.choice(labels, n, p=[0.55, 0.25, 0.15, 0.05])  # a hot label
    return [(i, f32(centre[label[i]] + centre[0] + 0.15 * rng.normal(size=dim)), int(label[i])) for i in range(n)]


@pytest.mark.parametrize("dim", [3, 8, 20])
def test_against_all_scores(spark, dim, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK", 64 * dim)  # many blocks and chunks
    monkeypatch.setattr(hn, "CHUNK", 16 * dim)
    rows = clustered(dim, dim=dim)
    rows += [(1000 + i, rows[3 + i % 2][1], i % 3) for i in range(200)]  # equal vectors, ties
    want = brute(rows, 10)
    assert len(want) > 500
    assert run(spark, rows) == want


def test_other_limits(spark):
    rows = clustered(9, n=250)
    options = dict(k=3, negatives=7, window=(50, 120, 100))
    assert run(spark, rows, **options) == brute(rows, 10, **options)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (0, [2.0, 2.0], 2), (0, [1.0, 2.0], 2), (10, None, 1), (20, [nan, 1.0], 1), (30, [inf, 0.0], 2),
            (40, [None, 1.0], 1), (50, [], 1), (1, [1.0, 1.9], 1), (2, [1.0, 1.8], 2), (3, [1.0, 1.8], 3), (4, [1.0, 1.7], None), (None, [1.0, 1.9], 1),
            (60, [1.0, 2.0, 3.0], 1), (5, [1.0, 2.0, 3.0], 1), (6, [0.0, 0.0], 1), (7, [-1.0, -2.0], 2), (70, [0.0, 0.0], 3), (8, [0.0, 0.0], 3)]
    want = brute(rows, 10)
    assert want and run(spark, rows) == want
    assert run(spark, rows[:0]) == []
    assert run(spark, rows[:2]) == []
    assert run(spark, [(i, [1.0], 1) for i in range(30)]) == []


def test_label_of_an_expression(spark):
    rows = clustered(2, n=200)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 4).otherwise(F.col("label"))
    assert run(spark, rows, label_col=label) == brute([(d, e, (y + 1) % 4 if d % 7 == 0 else y) for d, e, y in rows], 10)


@pytest.mark.parametrize("dim", [1, 7, 8, 9, 64])
@pytest.mark.parametrize("size", [1, 300, 1 << 20])
def test_lookups_are_full_inner_products(dim, size):
    rng = np.random.default_rng(dim)
    x = rng.integers(-size, size, (2500, dim))
    a = rng.integers(-size, size, (130, dim))
    got = np.zeros((2500, 130), dtype=np.int64)
    for rows, anchors, part in hn.scores(hn.planes(x), a):
        got[rows, anchors] = part
    assert (got == x @ a.T).all()


def test_subset_sums():
    a = np.array([[1, 10, 100, 1000, 10_000, 100_000, 1_000_000, 10_000_000, 5, 7]])
    table = hn.subset_sums(a)
    assert table.shape == (2, 256, 1) and table[0, 0b101, 0] == 101 and table[0, 255, 0] == 11_111_111
    assert table[1, 3, 0] == 12 and table[1, 0b100, 0] == 0


def test_too_large_scores_are_refused():
    with pytest.raises(ArithmeticError):
        list(hn.scores(hn.planes(np.full((2, 2), 1 << 40)), np.full((1, 2), 1 << 40)))
