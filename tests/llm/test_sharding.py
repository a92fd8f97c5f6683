"""Shards against a plain version of the law, and its properties on odd and skewed tables."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tamiz.llm import sharding

SCHEMA = "doc_id long, text string, size string, shard long, record int"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(d, t, "x", 7, 1) for d, t in rows], SCHEMA).repartition(parts)


def brute(rows, shards, whole=0.02):
    """Each row's (doc_id, size, crc, shard, slot), by one pass over the sorted rows."""
    items = sorted(
        (hashlib.md5((t or "").encode()).hexdigest(), d is not None, d or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
        for d, t in rows
    )
    total, start, own, groups = sum(x[3] for x in items), 0, [], {}
    for i, x in enumerate(items):
        own.append(min(shards - 1, (2 * start + x[3]) * shards // (2 * total)))
        groups.setdefault(x[0], []).append((i, start, x[3]))
        start += x[3]
    cuts = []
    for s in range(1, shards):
        c = sum(o < s for o in own)
        if 0 < c < len(items) and items[c - 1][0] == items[c][0]:
            g = groups[items[c][0]]
            size = sum(x[2] for x in g)
            if size * shards <= whole * total:
                c = g[-1][0] + 1 if (2 * g[0][1] + size) * shards < 2 * total * s else g[0][0]
        cuts.append(c)
    out = []
    for i, (_, known, d, size, crc) in enumerate(items):
        shard = sum(c <= i for c in cuts)
        out.append((d if known else None, size, crc, shard, i - (cuts[shard - 1] if shard else 0)))
    return sorted(out, key=repr)


def run(spark, rows, shards, **options):
    out = sharding.assign(frame(spark, rows), shards, **options)
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    got = out.collect()
    assert all(r["law"] == "bytes" and r["grown_shard"] is None for r in got)
    return sorted((tuple(r[c] for c in ("doc_id", "size", "text_crc32", "shard", "slot")) for r in got), key=repr)


def hot_rows():
    rows = [(i, "the one copied text " * 10) for i in range(3000)]
    rows += [(None, "") for _ in range(1500)]  # one key, rows equal in every column
    rows += [(5000 + i, f"wörd {i} " * (i % 30)) for i in range(3000)]
    return rows + [(9000 + i, f"long {i} " * 3000) for i in range(3)] + [(10000 + i, f"pair {i // 2}") for i in range(400)]


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_against_plain_version(spark, shards):
    assert run(spark, hot_rows(), shards) == brute(hot_rows(), shards)


def test_ranges_are_bounded_whatever_the_groups(spark):
    rows = hot_rows()
    text = F.coalesce("text", F.lit(""))
    docs = sharding.materialize(
        frame(spark, rows).select(
            F.monotonically_increasing_id().alias("row_"), F.col("doc_id").alias("id_"),
            (F.octet_length(text) + 16).cast("long").alias("size_"), F.md5(text.cast("binary")).alias("key_"),
        ), "rows",
    )
    n, total = docs.agg(F.count("*"), F.sum("size_")).first()
    ranged, wanted = sharding._ranges(docs, n, total)
    whole = Counter(r["range_"] for r in ranged.collect())
    assert max(whole.values()) > 1000  # a hot text fills one range
    parts = Counter((r["range_"], r["part_"]) for r in sharding._subdivided(ranged, wanted, n, total).collect())
    assert max(parts.values()) < 6 * n / wanted and len(parts) < 4 * wanted


def test_balance_and_whole_groups(spark):
    rows = [(i, f"text {i // 3} " * (1 + i // 3 % 9)) for i in range(6000)]
    got = run(spark, rows, 20)
    size, shards = Counter(), {}
    for d, n, crc, shard, _ in got:
        size[shard] += n
        shards.setdefault(crc, set()).add(shard)
    mean = sum(size.values()) / 20
    assert len(size) == 20 and max(abs(s - mean) for s in size.values()) <= 0.02 * mean + 100
    assert all(len(s) == 1 for s in shards.values())


def test_odd_tables(spark):
    assert run(spark, [], 40) == []
    assert run(spark, [(1, None)], 40) == brute([(1, None)], 40)
    rows = [(1, "a"), (1, "a"), (None, "a"), (None, None), (2, ""), (3, "\x00 é"), (3, None)]
    assert run(spark, rows, 3) == brute(rows, 3)


def test_written_shards_hold_the_whole_rows(spark, tmp_path):
    rows = hot_rows()[::3]
    out = sharding.write(frame(spark, rows), str(tmp_path / "shards"), 8)
    got = out.select("shard", "slot", "record.*").collect()
    assert sorted(((r[2], r[3]) for r in got), key=repr) == sorted(rows, key=repr)
    assert {(r[4], r[5], r[6]) for r in got} == {("x", 7, 1)}  # input columns with names of the result
    for shard, n in Counter(r[0] for r in got).items():
        assert sorted(r[1] for r in got if r[0] == shard) == list(range(n))
