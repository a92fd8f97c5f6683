"""The agenda against the sentencepiece library, and round trips."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tamiz.llm import pieces

P = pytest.importorskip("public_tokenizers")
MODEL = P.path("piece_bpe_32k.model")
ODD = ["", "a", "  a  b ", "▁", "a▁b", "<s> </s> <unk>", "\x00a\tb\r\n", "日本 語𐍈", " 　", "x" * 3000, "▁" * 500 + " " * 500]


def test_same_as_library():
    sp, agenda = pieces.load(MODEL)
    rnd = random.Random(1)
    chars = "ab e  ▁\t\nthé日\x00𐍈１<s>.0the in"
    texts = ODD + ["".join(rnd.choice(chars) for _ in range(rnd.randrange(60))) for _ in range(3000)]
    for t in texts:
        assert pieces.unpack(agenda.encode(t)) == sp.encode(t), t
    agenda.by_runs = False
    try:
        for t in texts[:400]:
            assert pieces.unpack(agenda.encode(t)) == sp.encode(t), t
    finally:
        agenda.by_runs = True


def test_slices_equal_single_texts():
    """Texts split by spaces together give what each gives alone."""
    _, agenda = pieces.load(MODEL)
    rnd = random.Random(2)
    words = ["the", "of", "é", "日本", "x" * 40, "a\tb", "\x00", "\n\n", "a.b"]
    texts = ODD + [" ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 30))) for _ in range(400)] + [" x", "x ", "x  y", "a b▁c"]
    for part in (texts, texts[::-1], texts[:1], []):
        ids, cuts = agenda.encode_all(pa.array(part, pa.large_string()))
        assert [ids[a:b].astype("<u4").tobytes() for a, b in zip(cuts, cuts[1:])] == [agenda.encode(t) for t in part]
        some, (i, j) = agenda.looked_up(pa.array(part, pa.large_string())), sorted((len(part) // 3, len(part) // 2))
        ids, cuts = some.ids(i, j)
        assert [ids[a:b].astype("<u4").tobytes() for a, b in zip(cuts, cuts[1:])] == [agenda.encode(t) for t in part[i:j]]
    both, cuts = pieces.enclosed(np.array([7, 8, 9], dtype="<u4"), np.array([0, 1, 1, 3]), 1, 2)
    assert both.tolist() == [1, 7, 2, 1, 2, 1, 8, 9, 2] and cuts.tolist() == [0, 3, 5, 9]


def test_operator(spark):
    sp, _ = pieces.load(MODEL)
    rows = [(i, t, "c", 7) for i, t in enumerate(ODD)] + [(0, "", "c", 7), (None, "null id", "c", 7), (50, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int")
    got = pieces.encode(docs, MODEL).collect()
    want = [(d, sp.encode(t or "", add_bos=True, add_eos=True)) for d, t, *_ in rows]
    assert sorted(((r.doc_id, pieces.unpack(r.ids)) for r in got), key=repr) == sorted(want, key=repr)
    text = {d: t or "" for d, t, *_ in rows}
    for r in got:
        assert r.decoded == sp.decode(pieces.unpack(r.ids))
        if r.doc_id is not None and "▁" not in text[r.doc_id]:
            assert r.decoded == text[r.doc_id]
    assert pieces.encode(docs.limit(0), MODEL).count() == 0


def test_a_difference_raises(spark):
    agenda = pieces.Agenda({"▁": (5, -9.0), "a": (6, -9.0), "▁a": (7, -1.0)}, [], 0)
    assert pieces.unpack(agenda.encode("a")) == [7]
    assert pieces.unpack(agenda.encode("ab a")) == [7, 0, 7]
