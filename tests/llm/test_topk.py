"""Top-k search against all scores."""

import math

import numpy as np

from tamiz.llm import topk


def brute(rows, k, every, scale=256):
    fine = {(d, tuple(math.floor(scale * float(x)) for x in e)) for d, e in rows
            if d is not None and e and all(x is not None and math.isfinite(x) for x in e)}
    out = []
    for q, v in fine:
        if q % every:
            continue
        scores = sorted((-sum(a * b for a, b in zip(v, w)), d) for d, w in fine if d != q and len(w) == len(v))[:k]
        out += [(q, i + 1, d, -s) for i, (s, d) in enumerate(scores)]
    return sorted(out)


def run(spark, rows, k=5, every=50, **options):
    df = spark.createDataFrame([(d, e, 1) for d, e in rows], "vec_id long, embedding array<float>, score int")
    return sorted(map(tuple, topk.search(df, lambda i: i % every == 0, k, **options).collect()))


def f32(x):
    return [float(v) for v in np.asarray(x, dtype=np.float32)]


def test_against_all_scores(spark):
    rng = np.random.default_rng(0)
    rows = [(i, f32(v)) for i, v in enumerate(rng.normal(size=(900, 24)) * 0.3)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(200)]  # many equal vectors
    rows += [(2000 + i, f32(np.array(rows[3][1]) + 0.01 * rng.normal(size=24))) for i in range(100)]
    for lists in (1, 2, 3):
        assert run(spark, rows, lists=lists) == brute(rows, 5, 50)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, None), (100, [nan, 1.0]), (150, [inf, 0.0]), (200, [None, 1.0]), (250, []),
            (1, [0.0, 0.0]), (2, [-1.0, -2.0]), (None, [1.0, 1.0]), (300, [1.0, 2.0, 3.0]), (350, [0.0, 0.0])]
    assert run(spark, rows) == brute(rows, 5, 50)
    assert run(spark, rows[:0]) == []
    assert run(spark, [(0, [1.0])]) == []


def test_negative_scores_and_few_candidates(spark):
    rows = [(i, [-1.0, 0.5 * (i % 3)] if i % 2 else [1.0, -0.25]) for i in range(4)] + [(50, [1.0, -1.0])]
    assert run(spark, rows, k=9) == brute(rows, 9, 50)
