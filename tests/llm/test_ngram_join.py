"""The n-gram Jaccard join against all pairs in plain Python."""

import random
import re

import numpy as np
import pytest

from tamiz.llm import ngram_join

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return set()
    return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)}


def brute(rows, words, num, den):
    sets = [shingles(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=repr)


def corpus(seed):
    rnd = random.Random(seed)
    word = [f"W{rnd.randrange(400)}" for _ in range(3000)]
    passage = word[:40]
    rows = []
    for base in range(25):
        size = rnd.choice([1, 2, 3, 4, 5, 9, 20, 60, 150, 400])
        text = [rnd.choice(word) for _ in range(size)]
        if rnd.random() < 0.4:
            text[size // 2 : size // 2] = passage
        for _ in range(rnd.choice([1, 2, 6, 12])):
            copy = list(text)
            for _ in range(rnd.choice([0, 1, 1, 2, max(1, size // 40), max(1, size // 25)])):
                copy[rnd.randrange(len(copy))] = rnd.choice(word)
            if rnd.random() < 0.2:
                copy = copy[: max(1, int(len(copy) * 0.9))]
            rows.append(" \t".join(copy))
    rnd.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("words,num,den", [(4, 85, 100), (5, 4, 5), (2, 1, 2)])
def test_against_all_pairs(spark, words, num, den):
    rows = corpus(words)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.classes(docs, words, num, den).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, words, num, den)


def test_odd_rows(spark):
    rows = [(5, None), (6, ""), (7, " \n "), (8, "A b"), (9, "a B"), (9, "a B"), (None, "a b"), (None, "only here now"),
            (3, "x " * 5000), (4, "X " * 5001), (1, "é É ñ q r"), (2, "é é ñ q r"), (2, "other text of two")]
    docs = spark.createDataFrame([(d, t, "n", 1) for d, t in rows], "doc_id long, text string, rep string, n int")
    got = ngram_join.classes(docs, 4, 85, 100)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 4, 85, 100)
    assert ngram_join.classes(docs.limit(0)).count() == 0
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    texts = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    gone = {(9, "a B"), (None, "a b"), (4, rows[9][1])}
    assert texts == sorted(set(rows) - gone, key=repr)
    blank = spark.createDataFrame([(None, t) for t in ("", None, "same text here now", "same text here now")], "doc_id long, text string")
    assert ngram_join.one_of_each(blank).count() == 3


def test_null_and_repeated_ids_keep_their_links(spark):
    """Sets that only rows without an id have, and texts of one id that are alike others."""
    rnd = random.Random(8)
    word = [f"w{i}" for i in range(500)]
    base = [[rnd.choice(word) for _ in range(60)] for _ in range(4)]

    def near(k, changes=1):
        text = list(base[k])
        for _ in range(changes):
            text[rnd.randrange(60)] = rnd.choice(word)
        return " ".join(text)

    rows = [(1, near(0)), (None, near(0)), (None, near(1)), (None, near(1)), (2, near(2, 0)), (2, near(0)), (2, near(3)), (3, near(3)), (3, near(3)),
            (4, near(2)), (None, near(2)), (7, near(1)), (7, near(1)), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 5, 1, 2)
    assert sorted(map(tuple, ngram_join.classes(docs, 5, 1, 2).collect()), key=repr) == want
    kept = [tuple(r) for r in ngram_join.one_of_each(docs, 5, 1, 2).collect()]
    classes = {}
    for (d, t), i in zip(rows, [next(k for k in range(4) if sum(x in t.split() for x in base[k]) > 45) if t else None for _, t in rows]):
        classes.setdefault(i, []).append((d, t))
    assert len(kept) == 5 and (7, "") in kept
    for k in range(4):
        mine = [r for r in kept if r in classes[k]]
        assert len(mine) == 1 and mine[0][0] == min(d for d, _ in classes[k] if d is not None)


def test_shared_rows_across_batches(spark):
    rnd = random.Random(3)
    rows = [(rnd.randrange(40), rnd.randrange(6)) for _ in range(150)] + [(99, 1)] * 30 + [(98, 1), (98, 2)]
    limit = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("1", "2", "7", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            got = [tuple(r) for r in ngram_join._shared(spark.createDataFrame(rows, "block long, key long")).collect()]
            want = {(b, k) for b, k in rows if len({k2 for b2, k2 in rows if b2 == b}) > 1}
            assert sorted(got) == sorted(want)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", limit)


def test_unions(spark):
    rows = [(1, 3, [1, 2, 3]), (1, 3, [3, 4, 1]), (2, 1, [-5, 7]), (2, 1, [7]), (3, 2, [])]
    got = {(r["g"], r["part"]): sorted(r["union"]) for r in ngram_join._unions(spark.createDataFrame(rows, "g long, parts long, tokens array<long>")).collect()}
    assert got == {(1, 0): [3], (1, 1): [1, 4], (1, 2): [2], (2, 0): [-5, 7]}


def test_blocks_share_one_above_the_threshold():
    rnd = np.random.default_rng(3)
    ends = ngram_join.levels(85, 100, 5000)
    for n in (8, 15, 40, 333, 2000):
        for _ in range(20):
            a = np.unique(rnd.integers(1, 1 << 63, n, dtype=np.uint64))
            drop = int(0.15 * len(a))
            b = np.unique(np.concatenate([a[drop:], rnd.integers(1, 1 << 63, rnd.integers(0, drop + 1), dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 85 * (len(a) + len(b) - both) and len(a) != both:
                assert len(np.intersect1d(ngram_join.blocks(a, ends, 85, 100), ngram_join.blocks(b, ends, 85, 100)))


@pytest.mark.parametrize("num,den", [(4, 5), (85, 100)])
def test_unrelated_sets_share_no_blocks(num, den):
    """Empty blocks are the same in all sets of a level; sent, they pair unrelated sets by the square of their number."""
    rnd = np.random.default_rng(3)
    ends = ngram_join.levels(num, den, 5000)
    for n in (60, 200, 700, 2000):
        sent = [ngram_join.blocks(np.unique(rnd.integers(0, 1 << 64, int(n * f), dtype=np.uint64)), ends, num, den) for f in np.linspace(0.9, 1.1, 60)]
        held = np.unique(np.concatenate([np.unique(s) for s in sent]), return_counts=True)[1]
        assert (held > 1).sum() <= 5
