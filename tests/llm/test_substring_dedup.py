"""Substring removal against a plain-Python restatement."""

import random
import re

import pytest

from tamiz.llm import substring_dedup

SCHEMA = "doc_id long, text string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows, window):
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if d is not None:
                first[key] = min(first.get(key, d), d)
    out = []
    for d, t in rows:
        w = words(t)
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def corpus(window, seed=1):
    rnd = random.Random(seed)
    vocabulary = [f"W{i}é" for i in range(300)]
    passages = [[rnd.choice(vocabulary) for _ in range(n)] for n in (window - 1, window, window + 1, 2 * window, 5 * window)]
    rows = []
    for d in range(60):
        text = [rnd.choice(vocabulary) for _ in range(rnd.choice([0, 1, window - 1, window, 3 * window]))]
        for _ in range(rnd.choice([0, 1, 2, 3])):
            p = rnd.choice(passages)
            i = rnd.randrange(len(text) + 1)
            text[i:i] = p
        if rows and rnd.random() < 0.4:  # near copy
            text = words(rnd.choice(rows)[1])
            for _ in range(rnd.choice([0, 1, 3])):
                if text:
                    text[rnd.randrange(len(text))] = rnd.choice(vocabulary)
        rows.append((rnd.randrange(10**6) * 100 + d, rnd.choice([" ", "\n", " \t "]).join(text)))
    rows.append((5, "one " * 4 * window))
    rows.append((6, "one " * 6 * window))
    return rows


@pytest.mark.parametrize("window", [10, 50, 120])
def test_against_plain_python(spark, window):
    rows = corpus(window)
    got = substring_dedup.remove(spark.createDataFrame(rows, SCHEMA), window)
    got = got.select("doc_id", "n_words", "n_removed", "text").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, window)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    part = " ".join(f"p{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, long), (4, "x " + long + " y"), (7, part), (7, part), (8, part + " tail"), (None, part + " more"),
            (9, "head " + part), (9, "other words here"), (10, part)]
    docs = spark.createDataFrame([(d, t, 5) for d, t in rows], "doc_id long, text string, n_words int")
    got = substring_dedup.remove(docs, 50).select("doc_id", "n_words", "n_removed", "text")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 50)
    assert substring_dedup.remove(docs.limit(0), 50).count() == 0
    with pytest.raises(ValueError):
        substring_dedup.remove(docs, 50, carry=("n_words",))


def test_spans_spacing_and_carried_columns(spark):
    part = " ".join(f"p{i}" for i in range(50))
    rows = [(1, "a\n" + part, "x"), (2, "b\n  c " + part + "\nd  e", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in substring_dedup.remove(docs, 50, carry=("lang",), spacing="kept").collect()}
    assert got[1].text == rows[0][1] and got[1].lang == "x" and got[1].spans == []
    assert got[2].text == "b\n  c d  e" and got[2].lang is None
    assert [tuple(s) for s in got[2].spans] == [(2, 52)]


def test_lengths_double():
    assert substring_dedup.lengths(50) == [25, 50]
    assert substring_dedup.lengths(120) == [15, 30, 60, 120]
    assert substring_dedup.lengths(10) == [10]
