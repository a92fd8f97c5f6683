"""Removal of passages that also stand in an earlier document, by level-wise doubling.

The lengths are the window's length halved until it is at most SEED_WORDS, then doubled again:
25 and 50 words for windows of 50. On the first length every window of the next length
contributes its seed, the run of the first length with the smallest hash inside it; two equal
windows have equal seeds. A run that occurs in two documents is repeated. On each further length
only windows made of repeated runs are candidates: those whose seed is repeated on the second
length, those whose two halves are repeated on the later ones. Lengths double until the window's
own is reached or no candidate is left.

A text that stands in several documents is judged once; its later copies are covered whole. The
decision about each window compares 128 bits of hash, seeds 64.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.runtime import materialize

from .components import small
from .words import Words, batches, mix, signed, strings, windows
from .worker import trimmed

_U = np.uint64
_FACTORS = (0xD6E8FEB86659FD93, 0xA3B195354A39B70D)
SEED_WORDS = 25
SPANS = T.ArrayType(T.StructType().add("start", "integer").add("stop", "integer"))
#: Bits for a word's position; above them stands which text of a document id it is.
_BITS = 32


def lengths(window: int) -> list[int]:
    out = [window]
    while out[-1] > SEED_WORDS:
        out.append((out[-1] + 1) // 2)
    return out[::-1]


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """The position of the leftmost smallest value in each run of ``width`` values."""
    n = len(values) - width + 1
    at, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        have += step
    return at[:n]


def _fingerprint(hashes: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _index(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """(doc_id, k1, k2, n, seeds, at): fingerprint of the word sequence, its seeds and their places."""

    def run(parts):
        for batch in parts:
            for i, j, data, offsets in batches(batch.column(1)):
                w = Words(data, offsets, lower=False)
                runs = mix(windows(w.hash, seed, _FACTORS[0]))
                least = leftmost_least(runs, window - seed + 1) if len(w.hash) >= window else None
                k1, k2, n, seeds, places = [], [], [], [], []
                for k in range(j - i):
                    a, b = int(w.first[k]), int(w.first[k + 1])
                    x, y = _fingerprint(w.hash[a:b])
                    k1.append(x)
                    k2.append(y)
                    n.append(b - a)
                    at = np.unique(least[a : b - window + 1]) if b - a >= window else np.zeros(0, dtype=np.int64)
                    seeds.append(signed(runs[at]))
                    places.append((at - a).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(n, pa.int64()),
                     pa.array(seeds, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32()))],
                    names=["doc_id", "k1", "k2", "n", "seeds", "at"],
                )

    return docs.mapInArrow(trimmed(run), "doc_id long, k1 long, k2 long, n long, seeds array<long>, at array<int>")


def _variants(texts: list | None) -> dict:
    return {t["k1"]: t for t in texts or []}


def _candidates(docs: DataFrame, alive: DataFrame, length: int, last: int, seeded: bool) -> DataFrame:
    """(h1, h2, doc_id, at) of every window of ``length`` words that the repeated runs allow.

    ``alive`` has (doc_id, texts, ats): the texts of an id and where runs of ``last`` words are repeated.
    """

    def run(parts):
        for batch in parts:
            for i, j, data, offsets in batches(batch.column(1)):
                w = Words(data, offsets, lower=False)
                out = [], [], [], []
                if len(w.hash) >= length:
                    h1 = mix(windows(w.hash, length, _FACTORS[0]))
                    h2 = mix(windows(w.hash, length, _FACTORS[1]))
                    if seeded:
                        least = leftmost_least(mix(windows(w.hash, last, _FACTORS[0])), length - last + 1)
                ids = batch.column(0).slice(i, j - i).to_pylist()
                texts = batch.column(2).slice(i, j - i).to_pylist()
                ats = batch.column(3).slice(i, j - i)
                for k in range(j - i):
                    a, b = int(w.first[k]), int(w.first[k + 1])
                    if b - a < length:
                        continue
                    mine = _variants(texts[k]).get(_fingerprint(w.hash[a:b])[0])
                    if mine is None or mine["whole"]:
                        continue
                    at = ats[k].values.to_numpy()
                    at = at[at >> _BITS == mine["variant"]] & ((1 << _BITS) - 1)
                    repeated = np.zeros(b - a, dtype=bool)
                    repeated[at] = True
                    if seeded:
                        start = np.flatnonzero(repeated[least[a : b - length + 1] - a])
                    else:
                        start = np.flatnonzero(repeated[: b - a - length + 1] & repeated[length - last : b - a - last + 1])
                    out[0].append(h1[a + start])
                    out[1].append(h2[a + start])
                    out[2].append(np.full(len(start), ids[k], dtype=np.int64))
                    out[3].append(start + (mine["variant"] << _BITS))
                if out[0]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(np.concatenate(out[0]))), pa.array(signed(np.concatenate(out[1]))),
                         pa.array(np.concatenate(out[2])), pa.array(np.concatenate(out[3]))],
                        names=["h1", "h2", "doc_id", "at"],
                    )

    rows = docs.select("doc_id", "text").join(small(alive.select("doc_id")), "doc_id", "left_semi").join(alive, "doc_id")
    return rows.select("doc_id", "text", "texts", "ats").mapInArrow(trimmed(run), "h1 long, h2 long, doc_id long, at long")


def _places(found: DataFrame, texts: DataFrame, how: str) -> DataFrame:
    """(doc_id, texts, ats): the found places (doc_id, at) of each document id."""
    ats = found.groupBy("doc_id").agg(F.collect_set("at").alias("ats"))
    return texts.join(ats, "doc_id", how).select("doc_id", "texts", "ats")


def remove(
    docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (),
    spacing: str = "one",
) -> DataFrame:
    """(doc_id, text, n_words, n_removed, spans, *carry) of every row of ``docs``.

    A word (bytes other than space and tab to carriage return, unchanged) goes when a window of
    ``window`` words that covers it has the same words as a window that starts in a row with a
    smaller id. Windows are judged on the input. ``spans`` are the removed words as (start, stop)
    word numbers. ``text`` holds the kept words, joined by one space, or with ``spacing="kept"``
    the text without the removed words and the white space after each.

    Only the named columns are read; names in ``carry`` that clash with a result column are
    refused by ValueError. A null text has no words and gives an empty text. A row with a null id
    loses nothing and removes nothing elsewhere. Rows with the same id never remove words from
    each other, whether their texts are equal or not. An empty table gives an empty result.
    """
    if set(carry) & {"doc_id", "text", "n_words", "n_removed", "spans"}:
        raise ValueError(f"carried columns clash with the result: {carry}")
    kept_spacing = {"one": False, "kept": True}[spacing]
    carried = [F.struct(*carry).alias("carried")] if carry else []
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *carried)
    sizes = lengths(window)
    index = materialize(_index(docs.select("doc_id", "text"), sizes[min(1, len(sizes) - 1)], sizes[0]), "seeds")

    keys = index.where(F.col("doc_id").isNotNull() & (F.col("n") >= window)).select("doc_id", "k1", "k2").distinct()
    first = keys.groupBy("k1", "k2").agg(F.min("doc_id").alias("first"))
    keys = keys.join(first, ["k1", "k2"]).select("doc_id", "k1", "k2", (F.col("doc_id") > F.col("first")).alias("whole"))
    texts = keys.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("k1", "k2", "whole"))).alias("texts"))
    texts = texts.select(
        "doc_id", F.transform("texts", lambda t, i: F.struct(t.k1.alias("k1"), t.k2.alias("k2"), i.cast("long").alias("variant"), t.whole.alias("whole"))).alias("texts")
    )
    texts = materialize(texts, "texts")

    judged = texts.select("doc_id", F.explode("texts").alias("t")).where("not t.whole").select(
        "doc_id", "t.k1", "t.k2", F.col("t.variant").alias("variant")
    )
    seeds = (
        index.select("doc_id", "k1", "k2", F.explode(F.arrays_zip("seeds", "at")).alias("s"))
        .join(judged, ["doc_id", "k1", "k2"])
        .select(F.col("s.seeds").alias("h1"), "doc_id", (F.shiftleft("variant", _BITS) + F.col("s.at")).alias("at"))
    )
    shared = seeds.groupBy("h1").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("h1")
    alive = seeds.join(shared, "h1").select("doc_id", "at")

    if len(sizes) == 1:  # the window itself is the first length
        least = seeds.groupBy("h1").agg(F.min("doc_id").alias("lo"))
        alive = seeds.join(least, "h1").where("lo < doc_id").select("doc_id", "at")
    for level, (last, length) in enumerate(zip(sizes, sizes[1:], strict=False)):
        places = materialize(_places(alive, texts, "inner"), "alive")
        if places.isEmpty():
            break
        wins = _candidates(docs, places, length, last, seeded=level == 0)
        if length == window:
            least = wins.groupBy("h1", "h2").agg(F.min("doc_id").alias("lo"))
            alive = wins.join(least, ["h1", "h2"]).where("lo < doc_id").select("doc_id", "at")
        else:
            ends = wins.groupBy("h1", "h2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
            alive = wins.join(ends, ["h1", "h2"]).select("doc_id", "at")

    side = _places(alive, texts, "left").where(F.col("ats").isNotNull() | F.exists("texts", lambda t: t.whole))
    side = materialize(side, "covered")
    out_schema = docs.select("doc_id", "text").schema.add("n_words", "long").add("n_removed", "long")
    out_schema = out_schema.add("spans", SPANS)
    if carry:
        out_schema = out_schema.add(docs.schema["carried"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for i, j, data, offsets in batches(batch.column(1)):
                w = Words(data, offsets, lower=False)
                keep = np.ones(len(w.start), dtype=bool)
                entries = batch.column(2).slice(i, j - i).to_pylist()
                ats = batch.column(3).slice(i, j - i)
                spans: list[list] = []
                removed = []
                for k in range(j - i):
                    a, b = int(w.first[k]), int(w.first[k + 1])
                    mine = _variants(entries[k]).get(_fingerprint(w.hash[a:b])[0]) if entries[k] and b - a >= window else None
                    gone = np.zeros(b - a + 1, dtype=np.int32)
                    if mine and mine["whole"]:
                        gone[0] = 1
                    elif mine and ats[k].is_valid:
                        at = ats[k].values.to_numpy()
                        at = at[at >> _BITS == mine["variant"]] & ((1 << _BITS) - 1)
                        np.add.at(gone, at, 1)
                        np.subtract.at(gone, at + window, 1)
                    covered = np.cumsum(gone[:-1]) > 0
                    keep[a:b] = ~covered
                    removed.append(int(covered.sum()))
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], covered.view(np.int8), [0])))).tolist()
                    spans.append([{"start": x, "stop": y} for x, y in zip(edge[::2], edge[1::2], strict=True)])
                text = strings(*(w.without(keep) if kept_spacing else w.joined(keep)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), text.cast(pa.string()), pa.array(np.diff(w.first).astype(np.int64)),
                     pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                     *(c.slice(i, j - i) for c in batch.columns[4:])],
                    names=["doc_id", "text", "n_words", "n_removed", "spans", "carried"][: 5 + bool(carry)],
                )

    # only texts that lose something are shuffled, unless their ids are too many to broadcast
    ids = side.select("doc_id")
    touched = docs.join(small(ids), "doc_id", "left_semi").join(side, "doc_id").select(*docs.columns, "texts", "ats")
    plain = docs.join(small(ids), "doc_id", "left_anti").select(
        *docs.columns, *(F.lit(None).cast(side.schema[c].dataType).alias(c) for c in ("texts", "ats"))
    )
    rows = touched.unionByName(plain).select("doc_id", "text", "texts", "ats", *(["carried"] if carry else []))
    out = rows.mapInArrow(trimmed(run), out_schema)
    return out.select("doc_id", "text", "n_words", "n_removed", "spans", *(F.col("carried").getField(c).alias(c) for c in carry))
