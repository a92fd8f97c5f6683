"""The classifier on planted words, unseen misspellings and held-out rows."""

import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tamiz.llm import toxicity
from tamiz.llm.queries import table

SF = "/root/testdata/sf0.1"


def planted(n, seed):
    rnd = random.Random(seed)
    plain = ["".join(rnd.choice("aeioubcdlmnrst") for _ in range(rnd.randrange(2, 9))) for _ in range(400)]
    bad = ["wretched", "horrible", "vermin", "disgrace"]
    texts, labels = [], []
    for i in range(n):
        words = [rnd.choice(plain) for _ in range(rnd.randrange(5, 120))]
        if i % 2:
            for _ in range(max(1, len(words) // 20)):
                words[rnd.randrange(len(words))] = rnd.choice(bad)
        texts.append(" ".join(words))
        labels.append(i % 2)
    return texts, np.array(labels), plain


def test_planted_words_and_misspellings():
    texts, labels, plain = planted(600, 1)
    bags = pa.array([sorted(set(toxicity.words_of(t))) for t in texts], pa.list_(pa.string()))
    table_, weights, bias = toxicity.fit(bags, labels)
    scorer = toxicity.Scorer((table_ @ (weights[:, 1] - weights[:, 0])).astype(float), float(bias[1] - bias[0]))
    rest, truth, _ = planted(300, 1)
    assert np.mean([(scorer.text(t) >= 0.5) == y for t, y in zip(rest, truth)]) > 0.97
    usual = np.median([scorer.word(w) for w in plain])
    for w in ("horribble", "wretchedd", "disgracce"):
        assert scorer.word(w) > usual + 3
    assert scorer.text(None) == scorer.text("") == scorer.text(" !? ")


def test_one_label_only():
    bags = pa.array([["a"], ["b"]], pa.list_(pa.string()))
    table_, weights, bias = toxicity.fit(bags, np.array([1, 1]))
    assert not table_.any() and not bias.any()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = toxicity.score(docs, labels).collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out and truth.get(r.doc_id) is not None]
    hits = sum(r.predicted and truth[r.doc_id] for r in held)
    assert hits >= 0.75 * sum(r.predicted for r in held)
    assert hits >= 0.45 * sum(truth[r.doc_id] for r in held)


def test_odd_rows(spark):
    rows = [(1, "good words"), (2, "bad words"), (3, None), (4, ""), (5, "?"), (None, "bad"), (6, "y" * 200_000), (6, "y" * 200_000)]
    docs = spark.createDataFrame([(d, t, "c") for d, t in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 0), (2, 1), (2, None), (None, 1), (9, 1), (6, 5), (1, 0)], "doc_id long, toxic int")
    got = toxicity.score(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (3, 4, 5)}) == 1
    assert toxicity.score(docs.limit(0), labels).count() == 0
    assert {r.score for r in toxicity.score(docs, labels.limit(0)).collect()} == {0.5}
