"""Pfair windows, deviation from exact targets and completeness."""

import math
import random
from fractions import Fraction

import pytest

from tamiz.llm import mixing


def ideal(blocks, weights, t):
    """What each source has poured when the stream is t slots long, in exact fractions, by draining them step by step."""
    left, done = dict(blocks), dict.fromkeys(blocks, Fraction(0))
    t = Fraction(t)
    while t > 0 and left:
        total = sum(Fraction(weights[k]) for k in left)
        step = min(t, min((blocks[k] - done[k]) * total / Fraction(weights[k]) for k in left))
        for k in left:
            done[k] += step * Fraction(weights[k]) / total
        t -= step
        left = {k: n for k, n in left.items() if done[k] < n}
    return done


@pytest.mark.parametrize("blocks,weights", [
    ({"a": 5}, {"a": 3}),
    ({"a": 40, "b": 40}, {"a": 1, "b": 1}),
    ({"a": 60, "b": 31, "c": 17, "d": 2}, {"a": 0.5, "b": Fraction(1, 3), "c": 0.2, "d": 0.00001}),
    ({str(i): 1 + i * 7 % 11 for i in range(40)}, {str(i): i * i + 1 for i in range(40)}),
])
def test_every_prefix_is_less_than_a_block_from_its_target(blocks, weights):
    plan = mixing.schedule(blocks, mixing.whole(weights))
    assert [p[2] for p in plan] == list(range(sum(blocks.values())))
    seen = dict.fromkeys(blocks, 0)
    for k, i, slot, release, deadline in plan:
        assert i == seen[k] and release <= slot < deadline
        assert ideal(blocks, weights, release)[k] <= i < ideal(blocks, weights, release + 1)[k]
        assert ideal(blocks, weights, deadline)[k] >= i + 1 > ideal(blocks, weights, deadline - 1)[k]
        seen[k] += 1
        for s, x in ideal(blocks, weights, slot + 1).items():
            assert abs(x - seen[s]) < 1


@pytest.mark.parametrize("sources", [4, 1000])
def test_a_long_stream_against_exact_targets(sources):
    """20,000 slots before any source ends; one source has a weight of 0.00001."""
    rnd = random.Random(sources)
    weights = {f"s{i}": Fraction(rnd.randrange(1, 1000), 997) for i in range(sources - 2)} | {"half": None, "tiny": None}
    rest = sum(w for w in weights.values() if w is not None)
    weights["half"] = rest  # half of the stream, but for the tiny one
    weights["tiny"] = 2 * rest * Fraction(1, 99_999)
    total = sum(weights.values())
    length = 20_000
    blocks = {k: math.ceil(w / total * length) + 2 for k, w in weights.items()}
    seen = dict.fromkeys(blocks, 0)
    for k, _, slot, release, deadline in mixing.schedule(blocks, mixing.whole(weights)):
        assert release <= slot < deadline
        if slot >= length:
            break
        seen[k] += 1
        assert abs(weights[k] / total * (slot + 1) - seen[k]) < 1
        if slot % 500 == 0 or sources < 10:
            assert all(abs(w / total * (slot + 1) - seen[s]) < 1 for s, w in weights.items())
    assert weights["tiny"] / total == Fraction(1, 100_000) and seen["tiny"] <= 1


def test_targets_hold_as_given():
    counts = {"a": 100, "b": 400, "c": 2500}
    assert mixing.targets(counts, None, 0.5) == {"a": 1, "b": 2, "c": 5}
    assert mixing.targets(counts, {"a": 0.5, "x": 9}, 0.5) == {"a": 1, "b": 2, "c": 5}
    assert mixing.targets(counts, {"a": Fraction(1, 100_000), "b": 1, "c": 1}, 0.5) == {"a": 1, "b": 100_000, "c": 100_000}
    assert mixing.targets({}, None, 0.5) == {}


def rows_of(spark, rows, **options):
    docs = spark.createDataFrame([(d, s, 1) for d, s in rows], "doc_id long, source string, position int")
    return docs, mixing.mix(docs, **options).collect()


def test_stream(spark):
    sizes = {"big": 2000, "mid": 700, None: 130}
    rows = [(i, "big") for i in range(2000)] + [(5000 + i, "mid") for i in range(700)] + [(9000 + i, None) for i in range(130)]
    weights = {"big": 2, "mid": 1, None: 1}
    _, got = rows_of(spark, rows, weights=weights, block_rows=8)
    assert sorted((r.doc_id, r.source) for r in got) == sorted(rows, key=lambda r: r[0])
    assert len({r.position for r in got}) == len(rows)
    assert all(r.release <= r.slot < r.deadline and r.position // 8 == r.slot and r.block_rows == 8 for r in got)
    blocks = {}
    for r in got:
        blocks.setdefault(r.slot, set()).add((r.source, r.block))
    assert all(len(b) == 1 for b in blocks.values()) and sorted(blocks) == list(range(len(blocks)))
    order = [next(iter(blocks[t])) for t in sorted(blocks)]
    number = {s: math.ceil(n / 8) for s, n in sizes.items()}
    seen = dict.fromkeys(sizes, 0)
    for t, (s, b) in enumerate(order):
        assert b == seen[s]
        seen[s] += 1
        if t % 20 == 0:
            assert all(abs(x - seen[k]) < 1 for k, x in ideal(number, weights, t + 1).items())


def test_many_sources(spark):
    rows = [(i, f"s{i % 1200}") for i in range(5000)]
    _, got = rows_of(spark, rows, block_rows=2)
    assert sorted((r.doc_id, r.source) for r in got) == sorted(rows)
    assert sorted({r.slot for r in got}) == list(range(len({(r.source, r.block) for r in got})))
    assert all(r.release <= r.slot < r.deadline for r in got)


def test_blocks_grow_where_they_would_be_too_many(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_BLOCKS", 10)
    _, got = rows_of(spark, [(i, "ab"[i % 3 == 0]) for i in range(2000)])
    assert {r.block_rows for r in got} == {200} and len({r.slot for r in got}) == 11
    assert sorted(r.doc_id for r in got) == list(range(2000)) and len({r.position for r in got}) == 2000


def test_ranges_do_not_change_the_ranks(spark, monkeypatch):
    rows = [(i % 900, "ab"[i % 7 == 0]) for i in range(1000)]
    _, one = rows_of(spark, rows)
    monkeypatch.setattr(mixing, "RANGE_ROWS", 30)
    _, many = rows_of(spark, rows)
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))


def test_odd_rows(spark):
    rows = [(1, "a"), (1, "a"), (None, "a"), (None, None), (2, ""), (3, "="), (4, "-")]
    docs, got = rows_of(spark, rows)
    assert sorted(((r.doc_id, r.source) for r in got), key=repr) == sorted(rows, key=repr)
    order = mixing.in_order(docs)
    assert order.columns == docs.columns
    assert sorted(map(tuple, order.collect()), key=repr) == sorted(((*r, 1) for r in rows), key=repr)
    assert mixing.mix(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, weights={"a": 0})
