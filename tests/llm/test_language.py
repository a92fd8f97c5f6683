"""Forward sums against all segmentations, expected counts against enumeration, held-out accuracy."""

import itertools
import math
import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tamiz.llm import language
from tamiz.llm.queries import piece_model, table

PIECES = ["▁", "a", "b", "ab", "▁a", "ba", "aba", "▁ab"]
SF = "/root/testdata/sf0.01"


def segmentations(word, lattice):
    s = "▁" + word
    for cuts in itertools.product([0, 1], repeat=len(s) - 1):
        ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(s)]
        parts = [s[a:b] for a, b in zip([0, *ends], ends)]
        if all(p in lattice.index or len(p) == 1 for p in parts):
            yield [lattice.index.get(p, 0) for p in parts]


def test_forward_and_expected_counts():
    lattice = language.Lattice(PIECES)
    rng = np.random.default_rng(0)
    p = rng.random((lattice.size, 3))
    p /= p.sum(axis=0)
    model = language.Model(lattice, ["x", "y", "z"], p)
    words = ["a", "ab", "abab", "babaab", "xé", "axb", "aaaaaaab"]
    got = model.log_words(words)
    uses = np.zeros(lattice.size)
    for w, row in zip(words, got, strict=True):
        ways = list(segmentations(w, lattice))
        each = np.array([[math.prod(p[i, lang] for i in way) for lang in range(3)] for way in ways])
        assert np.allclose(row, np.log(each.sum(axis=0)))
        for way, prob in zip(ways, each[:, 1], strict=True):
            for i in way:
                uses[i] += 2 * prob / each[:, 1].sum()
    assert np.allclose(model.expected(words, 1, np.full(len(words), 2)), uses)
    long = model.log_words(["ab" * 5000])
    assert np.isfinite(long).all() and (long < -1000).all()


def test_a_long_word_in_training_stands_alone(monkeypatch):
    """Places held at once are bounded by the longest word, not by it times the words around it."""
    lattice = language.Lattice(PIECES)
    model = language.Model(lattice, ["x"], np.full((lattice.size, 1), 1.0 / lattice.size))
    places, whole = [], language._pass
    monkeypatch.setattr(language, "_pass", lambda n, longest, *rest: places.append(n * longest) or whole(n, longest, *rest))
    words = ["ab" * (1 + i % 5) for i in range(3000)] + ["ab" * 1500]
    counts = np.arange(1, len(words) + 1)
    got = model.expected(words, 0, counts)
    assert max(places) <= 200_000
    alone = sum(model.expected([w], 0, counts[[i]]) for i, w in enumerate(words) if i % 300 == 0 or len(w) > 10)
    some = [i for i, w in enumerate(words) if i % 300 == 0 or len(w) > 10]
    assert np.allclose(model.expected([words[i] for i in some], 0, counts[some]), alone) and np.isfinite(got).all()


def test_score_does_not_depend_on_the_kept_words(monkeypatch):
    lattice = language.Lattice(PIECES)
    p = np.random.default_rng(1).random((lattice.size, 2))
    texts = pa.array(["ab ba", None, "12 !", "a" * 60 + " ab", "b b b", "ab ba", "", "ab\nba", "ab  ba "])
    model = language.Model(lattice, ["x", "y"], p)
    names, shares = model.score(texts)
    assert names[1] == names[2] == "und" and shares[1] == shares[2] == 0 and names[0] == names[5]
    assert names[6] == "und" and np.allclose(shares[7:], shares[0])  # other white space and more of it
    for i, t in enumerate(texts.to_pylist()):
        total = model.log_words(language.words_of(t)).sum(axis=0)
        if language.words_of(t):
            assert names[i] == model.languages[total.argmax()] and np.isclose(shares[i], 1 / np.exp(total - total.max()).sum())
    for name, value in (("KEPT_CHARS", 1), ("KEPT_TOKENS", 2)):
        monkeypatch.setattr(language, name, value)
        other = language.Model(lattice, ["x", "y"], p)
        for _ in range(3):
            again = other.score(texts)
            assert names == again[0] and np.allclose(shares, again[1])


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_slices_are_small():
    """A worker scores about 1 MB of text at a time, or one longer text, each row once and in order."""
    texts = pa.array(["of the " * n for n in (1, 400_000, 100, 0)] + ["a word " * 2000] * 500 + [None])
    found = list(language.slices(texts))
    assert [t for _, part in found for t in part.to_pylist()] == texts.to_pylist()
    assert [at for at, _ in found] == np.cumsum([0, *(len(part) for _, part in found)])[:-1].tolist()
    sizes = [sum(len(t or "") for t in part.to_pylist()) for _, part in found if len(part) > 1]
    assert max(sizes) <= 1 << 20 < sum(sizes)


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = language.identify(docs, piece_model()).collect()
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)


def test_repeated_ids_do_not_widen_the_sample(spark):
    rows = [(0, f"word{i} of it", "en") for i in range(300)] + [(0, "word1 of it", "en")] * 50 + [(i, "der die das", "de") for i in range(1, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert 0 in learned
    text = docs.select(F.col("doc_id").alias("id"), "lang", F.xxhash64("text").alias("h")).distinct()
    assert language.first_by_hash(text, "lang", 10, "h").groupBy("lang").count().where("count <> 10").count() == 0
    languages, _ = language.train(docs, piece_model(), sample=10)
    assert languages == ["de", "en"]


def test_odd_rows(spark):
    rows = [(1, "the of and", "en"), (2, "der die das", "de"), (3, None, "en"), (4, "", None), (5, "...", "de"), (None, "the", "en"),
            (6, "the the the", None), (6, "the the the", None), (7, "x" * 100_000, None)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    got = sorted(map(tuple, language.identify(docs, piece_model()).collect()), key=repr)
    assert len(got) == len(rows)
    pred = {r[0]: r[2] for r in got}
    assert pred[3] == pred[4] == pred[5] == "und" and "und" not in (pred[1], pred[2], pred[6], pred[7], pred[None])
    kept = language.accept(docs, piece_model())
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 2, 6, 7, None}
    nameless = language.accept(docs.withColumn("lang", docs["lang"].substr(9, 1)).where("lang is null or lang = ''").withColumn("lang", F.lit(None).cast("string")), piece_model())
    assert {r.doc_id for r in nameless.collect()} == {1, 2, 6, 7, None}  # nothing learned, nothing lost
    assert language.identify(docs.limit(0), piece_model()).count() == 0
    bare = language.identify(docs.withColumn("lang", docs["lang"].substr(9, 1)).where("lang is null"), piece_model())
    assert {r.lang_pred for r in bare.collect()} == {"und"}
