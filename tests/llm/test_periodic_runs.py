"""Periodic runs against all lags of every text, word by word."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tamiz.llm import periodic_runs, queries


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(ws, least=12):
    """(start, length, period) of every run, by comparing the words at every lag."""
    n, out = len(ws), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and ws[j] == ws[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in out.items())


def collapsed(ws, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(ws) if i not in gone)


def fibonacci(n):
    a, b = ["a"], ["a", "b"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def thue_morse(n):
    t = [0]
    while len(t) < n:
        t += [1 - x for x in t]
    return [f"t{x}" for x in t[:n]]


def texts(seed):
    rnd = random.Random(seed)
    pick = lambda k, n: [f"é{rnd.randrange(k)}" for _ in range(n)]
    out = [[], ["x"], ["x"] * 11, ["x"] * 12, ["x"] * 900, fibonacci(600), thue_morse(700), ["a", "b"] * 30 + ["b", "a"] * 30]
    for _ in range(14):
        out.append(pick(rnd.choice([1, 2, 3, 50]), rnd.choice([20, 60, 150, 400])))
        loop = pick(5, rnd.randint(1, 120))
        out.append((pick(9, 3) + loop * 6)[: rnd.randint(3, 500)] + pick(5, 30))
        inner = pick(3, rnd.randint(1, 6)) * rnd.randint(2, 20) + pick(3, rnd.randint(0, 10))
        out.append((inner * rnd.randint(2, 6))[:900])
        blocks = []
        while len(blocks) < 300:
            blocks += [rnd.choice("aaab")] * rnd.choice([1, 3, 30, 60])
        out.append(blocks)
        copied = pick(1000, 400)
        for _ in range(4):
            i, q = rnd.randrange(400), rnd.randint(1, 100)
            for k in range(i + q, min(400, i + 3 * q)):
                copied[k] = copied[k - q]
        out.append(copied)
    return [rnd.choice([" ", "\n", " \t"]).join(t) for t in out]


@pytest.mark.parametrize("least", [12, 2, 40])
def test_against_all_lags(spark, least):
    rows = [(i, t) for i, t in enumerate(texts(least))]
    out = periodic_runs.find(spark.createDataFrame(rows, "doc_id long, text string"), least)
    assert out.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        want = brute(words(t), least)
        assert [tuple(r) for r in got[i]["runs"]] == want
        assert got[i]["n_words"] == len(words(t)) and got[i]["collapsed"] == collapsed(words(t), want)


def test_every_period_from_short_to_long():
    """Two bare periods, the least that is a run, at every length and place."""
    rng = np.random.default_rng(1)
    for q in [*range(1, 70), 127, 128, 129, 255, 256, 300]:
        loop = rng.integers(1, 1 << 62, q).astype(np.uint64)
        pad = rng.integers(1, 1 << 62, 5).astype(np.uint64)
        h = np.concatenate((pad[:3], loop, loop, pad[3:], np.array([7], dtype=np.uint64)))
        got = periodic_runs.runs_of(h, np.array([len(h) - 1]), 2)
        assert got.tolist() == [[3, 3 + 2 * q, q]]


def test_a_failed_comparison_falls_back_to_the_scan():
    """Polynomial hashes modulo 2**64 confuse long Thue-Morse words; the comparison word by word finds out."""
    t = np.array([0])
    while len(t) < 4096:
        t = np.concatenate((t, 1 - t))
    rng = np.random.default_rng(2)
    letter = rng.integers(1, 1 << 62, 2).astype(np.uint64)
    h = np.concatenate((letter[t], letter[1 - t], letter[t], np.array([7], dtype=np.uint64)))
    got = periodic_runs.runs_of(h, np.array([len(h) - 1]), 12)
    assert len(got)
    for s, e, q in got.tolist():
        assert (h[s : e - q] == h[s + q : e]).all() and e - s >= max(12, 2 * q)
        assert (s == 0 or h[s - 1] != h[s - 1 + q]) and h[e] != h[e - q]
    lags = [periodic_runs.lag_runs(h, q, 12) for q in range(1, len(h) // 2)]
    assert got.tolist() == periodic_runs.smallest_periods(np.concatenate(lags)).tolist()


def test_seeds_stay_few_in_one_long_run():
    h = np.full(200_000, 99, dtype=np.uint64)
    h[-1] = 7
    known = periodic_runs.lag_runs(h, 1, 12)
    gram = periodic_runs.windows(h, 32, periodic_runs._FACTOR)
    assert sum(len(at) for at, _ in periodic_runs._seeds(gram, 64, known)) == 0
    assert periodic_runs.runs_of(h, np.array([len(h) - 1]), 12).tolist() == [[0, len(h) - 1, 1]]


def test_odd_rows(spark):
    long = "w " * 300_000 + "end"
    rows = [(1, None, "p"), (None, "a b " * 9, "q"), (2, "", "r"), (2, "a b " * 9, "s"), (2, "a b " * 9, "s"), (3, long, None), (4, "y" * 2_500_000, "t")]
    docs = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, note string, runs string")
    got = periodic_runs.find(docs, carry=("note",)).collect()
    loop = [(0, 18, 2)]
    want = {(1, "p"): [], (None, "q"): loop, (2, "r"): [], (2, "s"): loop, (3, None): [(0, 300_000, 1)], (4, "t"): []}
    assert len(got) == len(rows)
    for r in got:
        assert [tuple(x) for x in r["runs"]] == want[r["doc_id"], r["note"]]
    assert {r["collapsed"] for r in got if r["doc_id"] == 3} == {"w end"}
    assert periodic_runs.find(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.find(docs, carry=("runs",))


def restated(doc_id, text):
    """The query's row for one document, in plain Python."""
    ws, h = words(text), zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(ws)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]
    runs = brute(ws)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(collapsed(ws, runs)))


def test_query(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(i, t) for i, t in enumerate(texts(5))] + [(1000 + i, " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 120)))) for i in range(300)]
    rows.append((9999, None))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.QUERIES["op12_periodic_runs"](spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {tuple(r) for r in out.collect()} == {restated(*r) for r in rows}
