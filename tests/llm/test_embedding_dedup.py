"""Embedding links against all pairs."""

import math

import numpy as np

from tamiz.llm import embedding_dedup as ed


def brute(rows, cosine):
    fine = [e is not None and len(e) > 0 and lab is not None and all(x is not None and math.isfinite(x) for x in e) and any(e) for _, e, lab in rows]
    root = list(range(len(rows)))
    links = [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if fine[i] and fine[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1]), np.array(rows[j][1])
                if a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= cosine:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    out = []
    for i, (d, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        c = min(ids) if ids else None
        out.append((d, links[i], c, d == c))
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(d, e, lab, 1) for d, e, lab in rows], "vec_id long, embedding array<float>, label int, n_links int")
    return sorted(map(tuple, ed.link(df, 0.93).collect()), key=repr)


def test_hadamard():
    x = np.eye(8)
    h = ed.hadamard(x)
    assert np.allclose(h @ h.T, 8 * np.eye(8)) and set(np.unique(h)) == {-1.0, 1.0}


def test_recall_and_no_false_links(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 64))
    rows = []
    for i, v in enumerate(base):
        for _ in range(rng.integers(1, 5)):
            w = v + rng.normal(size=64) * rng.choice([0.0, 0.1, 0.2, 0.25, 0.28])
            rows.append((len(rows), [float(x) for x in w.astype(np.float32)], int(i % 3)))
    rows += [(len(rows) + i, [float(x) for x in (base[0] + 0.1 * rng.normal(size=64)).astype(np.float32)], 0) for i in range(700)]
    want, got = brute(rows, 0.93), run(spark, rows)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(sorted(got), sorted(want)))
    assert found >= 0.99 * there


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (2, [2.0, 4.0], 0), (3, [1.0, 2.0], 1), (4, [1.0, 2.0], None), (5, None, 0),
            (6, [0.0, 0.0], 0), (7, [nan, 1.0], 0), (8, [inf, 1.0], 0), (9, [None, 1.0], 0), (10, [], 0), (11, [1.0, 2.0, 3.0], 0),
            (None, [1.0, 2.0], 0), (None, [5.0, -1.0], 0), (12, [1e30, 2e30], 0), (13, [1e-30, 2e-30], 0), (14, [-0.0, 1.0], 2), (15, [0.0, 1.0], 2)]
    assert run(spark, rows) == brute(rows, 0.93)
    assert run(spark, rows[:0]) == []
