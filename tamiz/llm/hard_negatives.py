"""Hard negatives by Four-Russians scoring: exact integer inner products from tables of subset sums.

An anchor's dimensions are cut into groups of eight, and each group gets a table of the 256 sums of a subset of its
components. A candidate is stored as bit planes: for every bit of its components (two's complement) and every group,
one byte says which of the eight have the bit. A score is then the sum over bits of 2**bit times the looked-up
subset sums, formed from the highest bit down by doubling and adding; the sign bit counts negative. Nothing is
rounded, so the scores are the full inner products.

Candidates are packed in blocks of one label, anchors in chunks, and a (block, chunk) pair is one unit of work:

1. blocks meet the anchors of their own label: the best of them are an anchor's positives;
2. blocks meet chunks of all anchors with their positives' scores, leaving out the anchors of the block's label:
   for each positive the best rows inside its score window.

So each pair of anchor and row is scored once. A unit returns a bounded number of rows for each anchor it holds, and a label
that fills most of the table only has more blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.runtime import materialize

#: Components of a block of candidates, and of a chunk of anchors.
BLOCK, CHUNK = 1 << 18, 1 << 18
#: Candidates and anchors scored at a time; their running sums stay in the processor's cache.
ROWS, ANCHORS = 1024, 64
#: Tasks that the units are dealt out to.
MOST_TASKS = 20_000


def planes(v: np.ndarray) -> np.ndarray:
    """Bytes (bits, groups, rows) of integer rows in two's complement, the sign's bit last."""
    n, dim = v.shape
    largest = max(int(v.max(initial=0)), -1 - int(v.min(initial=0)))
    padded = np.zeros((n, -(-dim // 8) * 8), dtype=np.int64)
    padded[:, :dim] = v
    out = [np.packbits((padded >> b) & 1 != 0, axis=1, bitorder="little").T for b in range(largest.bit_length() + 1)]
    return np.ascontiguousarray(np.stack(out))


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Tables (groups, 256, anchors): sums of the components that the bits of a byte name."""
    n, dim = anchors.shape
    padded = np.zeros((-(-dim // 8) * 8, n), dtype=anchors.dtype)
    padded[:dim] = anchors.T
    out = np.zeros((len(padded) // 8, 256, n), dtype=anchors.dtype)
    for bit in range(8):
        out[:, 1 << bit : 2 << bit] = out[:, : 1 << bit] + padded[bit::8][:, None, :]
    return out


def scores(packed: np.ndarray, anchors: np.ndarray) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """(rows, anchors, scores) in parts; raises ArithmeticError where a score may exceed 54 bits."""
    bits, groups, n = packed.shape
    largest = int(np.abs(anchors.astype(object)).sum(axis=1).max()) << bits if len(anchors) else 0
    if largest >= 1 << 54:
        raise ArithmeticError("inner products may exceed 54 bits")
    kind = np.int32 if largest < 1 << 30 else np.int64
    for a in range(0, len(anchors), ANCHORS):
        table = subset_sums(anchors[a : a + ANCHORS].astype(kind))
        for i in range(0, n, ROWS):
            part = packed[:, :, i : i + ROWS]
            total = -table[0].take(part[-1, 0], axis=0)
            for g in range(1, groups):
                total -= table[g].take(part[-1, g], axis=0)
            for b in range(bits - 2, -1, -1):
                total += total
                for g in range(groups):
                    total += table[g].take(part[b, g], axis=0)
            yield slice(i, i + ROWS), slice(a, a + ANCHORS), total


def best(score: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` highest allowed scores of each column, the first rows of equal ones."""
    low = np.iinfo(score.dtype).min
    held = np.where(allowed, score, low)
    if len(held) > k:
        least = np.partition(held, len(held) - k, axis=0)[len(held) - k]
        allowed = allowed & (held >= least)
    row, column = np.nonzero(allowed)
    order = np.lexsort((row, -held[row, column].astype(np.int64), column))
    row, column = row[order], column[order]
    nth = np.arange(len(column)) - np.searchsorted(column, column)
    return row[nth < k], column[nth < k]


def _matrix(values: pa.Array, dim: int) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.int64)


def _blocks(rows: DataFrame) -> DataFrame:
    """(dim, label, block, bits, ids, planes): candidates of one label packed together, in order of their ids."""
    size = F.greatest(F.lit(64), F.floor(F.lit(BLOCK) / F.col("dim")))
    held = rows.groupBy("dim", "label").agg(F.count("*").alias("held"))
    packed = (
        rows.join(held, ["dim", "label"])
        .withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), F.ceil(F.col("held") / size)))
        .groupBy("dim", "label", "block").agg(F.sort_array(F.collect_list(F.struct("id", "v"))).alias("r"))
        .select("dim", "label", "block", F.col("r.id").alias("ids"), F.flatten("r.v").alias("flat"))
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                p = planes(_matrix(one.column(4)[0].values, one.column(0)[0].as_py()))
                yield pa.RecordBatch.from_arrays(
                    [*one.columns[:3], pa.array([len(p)], pa.int32()), one.column(3), pa.array([p.tobytes()], pa.binary())],
                    names=["dim", "label", "block", "bits", "ids", "planes"],
                )

    label = rows.schema["label"].dataType.simpleString()
    out = packed.mapInArrow(run, f"dim int, label {label}, block long, bits int, ids array<long>, planes binary")
    return materialize(out, "candidates")


def _chunks(anchors: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """(by, chunk, one array of each column, flat): anchors packed together, in order of their labels."""
    size = F.greatest(F.lit(16), F.floor(F.lit(CHUNK) / F.col("dim")))
    held = anchors.groupBy(*by).agg(F.count("*").alias("held"))
    fields = ["label", "a", "own", *columns, "v"]
    return materialize(
        anchors.join(held, by).withColumn("chunk", F.pmod(F.xxhash64("a", F.lit(5)), F.ceil(F.col("held") / size)))
        .groupBy(*by, "chunk").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("r"))
        .select(*by, "chunk", *[F.col(f"r.{c}").alias(f"{c}s") for c in fields[:-1]], F.flatten("r.v").alias("flat")),
        "anchors",
    )


def _units(blocks: DataFrame, chunks: DataFrame, by: list[str]) -> DataFrame:
    """Every block beside every chunk of its group, dealt out by the pair."""
    block, chunk = ["dim", "label", "block"], [*by, "chunk"]
    names = [c for c in chunks.columns if c not in chunk]
    pairs = blocks.select(*block).join(chunks.select(*chunk), by)
    pairs = materialize(pairs.select(F.monotonically_increasing_id().alias("unit"), *dict.fromkeys([*block, *chunk])), "units")
    # a number of tasks, since adaptive execution would put units of few bytes and much work into one
    tasks = max(1, min(pairs.count(), MOST_TASKS))
    left = pairs.join(blocks, block).select("unit", *blocks.columns).repartition(tasks, "unit")
    right = pairs.join(chunks, chunk).select("unit", *names).repartition(tasks, "unit")
    return left.join(right.hint("shuffle_hash"), "unit")


def _packed(row: dict, dim: int) -> np.ndarray:
    return np.frombuffer(row["planes"].as_py(), dtype=np.uint8).reshape(row["bits"].as_py(), -(-dim // 8), -1)


def _units_of(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in parts:
        for i in range(batch.num_rows):
            yield {name: batch.column(j)[i] for j, name in enumerate(batch.schema.names)}


def _first(found: list[np.ndarray], k: int, names: list[str]) -> pa.RecordBatch:
    """Of a unit's finds the ``k`` with the highest scores, then the smallest ids, for each value of the columns before these two."""
    *group, ids, score = found
    order = np.lexsort((ids, -score, *group))
    found = [c[order] for c in found]
    change = np.zeros(len(order), dtype=bool)
    for c in found[:-2]:
        change[1:] |= c[1:] != c[:-1]
    at = np.arange(len(order))
    keep = at - np.maximum.accumulate(np.where(change, at, 0)) < k
    return pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in found], names=names)


def _joined(parts: list[tuple]) -> list[np.ndarray]:
    return [np.concatenate(c).astype(np.int64) for c in zip(*parts, strict=True)]


def _positives(units: DataFrame, k: int) -> DataFrame:
    """(a, id, score): each unit's ``k`` best rows for each anchor, its own id left out."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _units_of(parts):
            dim = row["dim"].as_py()
            ids, anchor, own = (row[c].values.to_numpy() for c in ("ids", "as", "owns"))
            found = []
            for x, a, score in scores(_packed(row, dim), _matrix(row["flat"].values, dim)):
                r, c = best(score, ids[x][:, None] != own[a][None, :], k)
                found.append((anchor[a][c], ids[x][r], score[r, c]))
            yield _first(_joined(found), k, ["a", "id", "score"])

    return units.mapInArrow(run, "a long, id long, score long")


def _negatives(units: DataFrame, k: int, low: int, high: int, of: int) -> DataFrame:
    """(a, positive, id, score): each unit's ``k`` best rows of other labels in the score window of each positive."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _units_of(parts):
            dim, label = row["dim"].as_py(), row["label"].as_py()
            other = np.array([x != label for x in row["labels"].as_py()], dtype=bool)
            if not other.any():
                continue
            ids, anchor, own = row["ids"].values.to_numpy(), row["as"].values.to_numpy()[other], row["owns"].values.to_numpy()[other]
            limits = row["limits"].as_py()
            limits = [limits[i] for i in np.flatnonzero(other)]
            most = max(len(x) for x in limits)
            has = np.array([[p < len(x) for p in range(most)] for x in limits])
            limit = np.array([[x[p] if p < len(x) else 0 for p in range(most)] for x in limits], dtype=np.int64)
            floor, ceiling = -((-low * limit) // of), high * limit // of  # whole scores from floor to ceiling
            found = []
            for x, a, score in scores(_packed(row, dim), _matrix(row["flat"].values, dim)[other]):
                strange = ids[x][:, None] != own[a][None, :]
                for p in range(most):
                    allowed = (score >= floor[a, p]) & (score <= ceiling[a, p]) & has[a, p] & strange
                    r, c = best(score, allowed, k)
                    found.append((anchor[a][c], np.full(len(r), p), ids[x][r], score[r, c]))
            yield _first(_joined(found), k, ["a", "positive", "id", "score"])

    return units.mapInArrow(run, "a long, positive long, id long, score long")


def mine(
    vectors: DataFrame, is_anchor, k: int = 5, negatives: int = 5, window: tuple[int, int, int] = (80, 100, 100), scale: float = 256.0,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | Column = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on the id column. A component x becomes floor(scale * x) and a row's score for an
    anchor is the integer inner product. An anchor's positives are its first ``k`` other rows of the same label,
    higher scores first, ties to the smaller id. For each positive of score s the first ``negatives`` rows of another
    label come back whose score t satisfies low * s <= of * t <= high * s, with ``window`` = (low, high, of);
    ``rank`` numbers them from 1. Positives without such a row give no rows, and so does a positive of negative
    score when low < high, as its window is empty.

    Reads only the three columns, so extra columns cannot clash. Rows whose label, vector or id is null, or whose vector
    is empty or holds a null or non-finite component, take no part. Rows with equal id, label and vector count once; rows
    that share only the id are rows of their own, each an anchor when the id is one, and none of them is a positive
    or negative of an anchor with its id. Rows meet only when their vectors have equally many components. A
    score that may exceed 54 bits raises an ArithmeticError. An empty table, or one of one label, gives an empty result.
    """
    label = F.col(label_col) if isinstance(label_col, str) else label_col
    low, high, of = window
    clean = vectors.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), F.col(vector_col).cast("array<double>").alias("e")).where(
        "id is not null and label is not null and size(e) > 0"
        " and forall(e, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
    )
    rows = clean.select("id", "label", F.size("e").alias("dim"), F.transform("e", lambda x: F.floor(x * F.lit(scale))).alias("v"))
    rows = materialize(rows.distinct(), "vectors")
    anchors = rows.where(is_anchor(F.col("id"))).select(F.monotonically_increasing_id().alias("a"), F.col("id").alias("own"), "label", "dim", "v")
    anchors = materialize(anchors, "anchors")
    blocks = _blocks(rows)

    near = _positives(_units(blocks, _chunks(anchors, ["dim", "label"], []).drop("labels"), ["dim", "label"]), k)
    order = Window.partitionBy("a").orderBy(F.desc("score"), "id")
    positives = materialize(
        near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).select("a", (F.col("n") - 1).alias("positive"), "id", "score"),
        "positives",
    )
    limit = positives.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("positive", "score"))).alias("p"))
    asked = anchors.join(limit.select("a", F.col("p.score").alias("limit")), "a")
    far = _negatives(_units(blocks, _chunks(asked, ["dim"], ["limit"]), ["dim"]), negatives, low, high, of)
    own = anchors.select("a", F.col("own").alias("anchor_id"))
    order = Window.partitionBy("a", "positive").orderBy(F.desc("negative_score"), "negative_id")
    far = far.select("a", "positive", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    ranked = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    of_positive = positives.select("a", F.col("positive").cast("long").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return ranked.join(of_positive, ["a", "positive"]).join(own, "a").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
