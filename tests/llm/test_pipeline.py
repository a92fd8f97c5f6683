"""Every stage of the pipeline against plain Python, on the smallest tables."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pipeline = pytest.importorskip("corpus_pipeline")

from tamiz.llm import pieces  # noqa: E402
from tamiz.llm.queries import piece_model  # noqa: E402
from tamiz.runtime import BATCH_KEY  # noqa: E402

from .test_ngram_join import brute as brute_classes  # noqa: E402
from .test_substring_dedup import brute as brute_removed  # noqa: E402
from .test_substring_dedup import words  # noqa: E402

SF = "/root/testdata/sf0.001"


def stages(spark, docs):
    out = [docs]
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        out.append(docs)
    return [d.collect() for d in out], [d.columns for d in out]


def check(spark, docs):
    (rows, kept, single, cut, mixed, encoded), columns = stages(spark, docs)
    assert all(c == pipeline.COLUMNS for c in columns[1:5])
    original = {(r.doc_id, r.text) for r in rows}
    assert {(r.doc_id, r.text) for r in kept} <= original
    want = {(d, c) for d, _, c in brute_classes([(r.doc_id, r.text) for r in kept], 5, 4, 5) if d == c}
    assert {r.doc_id for r in single if r.doc_id is not None} == {d for d, _ in want if d is not None}
    removed = {d: (n, gone, text) for d, n, gone, text in brute_removed([(r.doc_id, r.text) for r in single], 50)}
    assert {r.doc_id for r in cut} == {d for d, (n, gone, _) in removed.items() if not gone or gone < n}
    texts = {r.doc_id: r.text for r in single}
    for r in cut:
        assert " ".join(words(r.text)) == removed[r.doc_id][2]
        assert removed[r.doc_id][1] or r.text == (texts[r.doc_id] or "")
    assert sorted(map(tuple, mixed), key=repr) == sorted(map(tuple, cut), key=repr)
    sp, _ = pieces.load(piece_model())
    text = {r.doc_id: r.text for r in mixed}
    assert sorted((r.doc_id for r in encoded), key=repr) == sorted(text, key=repr)
    for r in encoded:
        ids = sp.encode(text[r.doc_id], add_bos=True, add_eos=True)
        assert pieces.unpack(r.ids) == ids and r.n_tokens == len(ids) and r.decoded == sp.decode(ids)
    return rows, kept, single, cut


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows, kept, single, cut = check(spark, docs)
    assert len(kept) == len(rows)  # all of them are prose
    assert len(single) < len(kept)
    got = pipeline.run(spark, SF)
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in cut)


def test_odd_rows(spark):
    prose = "The of and to in is that it was for on with as by the end "
    part = " ".join(f"{w}{c}" for c in "abcdef" for w in prose.split())
    rows = [(1, None), (2, ""), (3, "12 34 !!"), (4, prose), (5, part + " more words"), (6, "a start of it " + part + " the rest"), (None, prose * 3),
            (7, prose * 400), (8, part)]
    docs = spark.createDataFrame([(d, t, "en" if d != 4 else None, None if d == 7 else "s", None) for d, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    _, kept, _, cut = check(spark, docs)
    assert {r.doc_id for r in kept} == {4, 5, 6, 7, 8, None}
    assert 8 not in {r.doc_id for r in cut}
    check(spark, docs.limit(0))


def test_positions_are_the_stream(spark, tmp_path, monkeypatch):
    """run()'s positions are the mixer's order, each source within one block of its target until one ends."""
    sizes = {"a": 3000, "b": 1200, "c": 500}
    rows = [(i, f"{s} text {i}", "en", s, 1) for s in sizes for i in range(ord(s) * 10_000, ord(s) * 10_000 + sizes[s])]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(pipeline, "STAGES", [s for s in pipeline.STAGES if s[0] in ("mixing", "pieces")])
    got = {r.position: r.doc_id for r in pipeline.run(spark, str(tmp_path)).collect()}
    assert sorted(got) == list(range(len(rows)))
    plan = sorted(pipeline.mixing.mix(docs).collect(), key=lambda r: r.position)
    assert [got[p] for p in sorted(got)] == [r.doc_id for r in plan]
    counts = {f"={k}": n for k, n in sizes.items()}
    weight = {k[1:]: w for k, w in pipeline.mixing.targets(counts, None, 0.5).items()}
    share = {k: w / sum(weight.values()) for k, w in weight.items()}
    seen, at = dict.fromkeys(sizes, 0), 0
    while all(seen[s] + 64 <= sizes[s] for s in sizes):  # whole blocks, before a source ends
        for p in range(at, at + 64):
            seen[chr(got[p] // 10_000)] += 1
        at += 64
        assert all(abs(seen[s] - share[s] * at) < 64 for s in sizes)
    assert at > 1000


def test_batches_are_small(spark):
    """Every stage with Python workers hands them some MB at a time, however long the texts are."""

    def sizes(parts):
        for b in parts:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["size"])

    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("of the "), 6000).alias("text"), F.lit("en").alias("lang"),
                                   F.lit("s").alias("source"), F.lit(42000).cast("long").alias("n_chars")).coalesce(1)
    before = spark.conf.getAll.get(BATCH_KEY)
    try:
        for name, stage in pipeline.STAGES:
            if name != "mixing":
                spark.conf.unset(BATCH_KEY)
                stage(spark, docs.limit(3), SF)
                found = [r.size for r in docs.mapInArrow(sizes, "size long").collect()]
                assert sum(found) > 16 << 20 and max(found) < 5 << 20, name
        spark.conf.set(BATCH_KEY, "2m")  # the session's own bound stays
        pipeline.encode_pieces(spark, docs, SF)
        assert spark.conf.get(BATCH_KEY) == "2m"
    finally:
        spark.conf.unset(BATCH_KEY)
        if before is not None:
            spark.conf.set(BATCH_KEY, before)
