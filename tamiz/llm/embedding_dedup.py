"""Near-duplicate embeddings by cross-polytope hashing after fast Hadamard rotations.

A table's code of a vector joins ``hashes`` cross-polytope hashes. Each hash rotates the vector by
three rounds of random signs and a Walsh-Hadamard transform, and takes the largest coordinate with
its sign. A vector also enters the buckets that differ in one hash, the runner-up coordinate, where
the loss is least (multiprobe). Two vectors are candidates when they share a bucket; every
candidate pair is verified by its cosine in double precision.

Equal vectors are one point. A bucket is dealt out in pairs of blocks, so its members never meet
in one task as a whole; a task returns link counts and which members belong together, not pairs.
A pair is counted in the first bucket it shares.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.runtime import materialize

from .cells import groups, joined
from .components import components

#: Members of a bucket that are compared in one block.
BLOCK = 512


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row; the length is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(n, d)
        h *= 2
    return x


def codes(x: np.ndarray, tables: int, hashes: int, probes: int, seed: int) -> np.ndarray:
    """Bucket codes, shape (rows, tables, probes); a row's unused probes repeat its first."""
    n, dim = x.shape
    size = 1 << max(1, int(np.ceil(np.log2(max(2, dim)))))
    padded = np.zeros((n, size))
    padded[:, :dim] = x
    rng = np.random.default_rng([seed, dim])
    out = np.empty((n, tables, probes), dtype=np.int64)
    rows = np.arange(n)
    for t in range(tables):
        base = np.zeros(n, dtype=np.int64)
        moved, loss = [], []
        for h in range(hashes):
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], size)) / np.sqrt(size)
            a = np.abs(y)
            first = a.argmax(axis=1)
            top = a[rows, first]
            a[rows, first] = -1
            second = a.argmax(axis=1)
            scale = (2 * size) ** h
            one = 2 * first + (y[rows, first] < 0)
            two = 2 * second + (y[rows, second] < 0)
            base += one * scale
            moved.append((two - one) * scale)
            loss.append(top - a[rows, second])
        out[:, t, :] = base[:, None]
        order = np.argsort(np.stack(loss, axis=1), axis=1, kind="stable")
        change = np.stack(moved, axis=1)
        for p in range(1, min(probes, hashes + 1)):
            out[:, t, p] += change[rows, order[:, p - 1]]
    return out


def _coded(points: DataFrame, tables: int, hashes: int, probes: int, seed: int) -> DataFrame:
    """(point, label, dim, copies, unit, codes) of the points."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims):
                rows = batch.filter(pa.array(dims == dim))
                x = rows.column(4).flatten().to_numpy().reshape(-1, dim)
                largest = np.abs(x).max(axis=1, keepdims=True)  # squares of huge or tiny values stay finite
                x = x / largest
                x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
                c = codes(x, tables, hashes, probes, seed)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), rows.column(2), rows.column(3),
                     pa.array(list(x), pa.list_(pa.float64())), pa.array(list(c.reshape(len(x), -1)), pa.list_(pa.int64()))],
                    names=["point", "label", "dim", "copies", "unit", "codes"],
                )

    label = points.schema["label"].dataType.simpleString()
    return points.select("point", "label", "dim", "copies", "e").mapInArrow(
        run, f"point long, label {label}, dim int, copies long, unit array<double>, codes array<long>"
    )


def _first_shared(ca: np.ndarray, cb: np.ndarray, table: int, code: int) -> np.ndarray:
    """Whether (table, code) is the first bucket that the rows of ca and cb share."""
    same = ca[:, : table + 1, :, None] == cb[:, : table + 1, None, :]
    earlier = same[:, :table].any(axis=(1, 2, 3))
    here = np.where(same[:, table].any(axis=2), ca[:, table], np.iinfo(np.int64).max).min(axis=1)
    return ~earlier & (here == code)


def _verified(cells: DataFrame, cosine: float, tables: int, probes: int) -> DataFrame:
    """(point, links, other): link counts of the cells' members, and a member of the same class."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in groups(parts, 5):
            table, code, dim = (cell.column(k)[0].as_py() for k in (1, 2, 10))
            lo, hi = cell.column(3)[0].as_py(), cell.column(4)[0].as_py()
            block, point, copies = (cell.column(k).to_numpy() for k in (5, 6, 7))
            x = cell.column(8).combine_chunks().flatten().to_numpy().reshape(-1, dim)
            c = cell.column(9).combine_chunks().flatten().to_numpy().reshape(-1, tables, probes)
            first, second = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
            close = x[first] @ x[second].T >= cosine
            if lo == hi:
                close = np.triu(close, 1)
            a, b = np.nonzero(close)
            a, b = first[a], second[b]
            keep = np.concatenate(
                [_first_shared(c[a[i : i + 50_000]], c[b[i : i + 50_000]], table, code) for i in range(0, len(a), 50_000)]
                or [np.zeros(0, dtype=bool)]
            )
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            links = np.zeros(len(point), dtype=np.int64)
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            other = point[joined(len(point), a, b)]
            some = links > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(point[some]), pa.array(links[some]), pa.array(other[some])], names=["point", "links", "other"]
            )

    return cells.mapInArrow(run, "point long, links long, other long")


def link(
    vectors: DataFrame, cosine: float = 0.93, tables: int = 10, hashes: int = 2, probes: int = 3, seed: int = 5,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors``.

    Rows link when their labels are equal and not null and the cosine is at least ``cosine``.
    Pairs come from the hash buckets, so a link can be missed, and none is made below the
    threshold. n_links counts the other rows linked directly, component_id is the smallest id
    reachable by links, itself included, kept says that the row has that id.

    Reads only the three named columns, so extra columns cannot clash. Vectors that are null,
    empty, zero or hold null or non-finite components link with nothing. Vectors of different
    lengths never link. Repeated rows are rows: they link with each other. A row with a null id
    links and counts, but gives no id; alone its component is null and it is kept. An empty table
    gives an empty result.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("e")
    )
    fine = F.coalesce(
        F.expr(
            "label is not null and size(e) > 0 and forall(e, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
            " and exists(e, x -> x <> 0)"
        ),
        F.lit(False),
    )
    rows = rows.withColumn("e", F.when(fine, F.col("e")))
    points = rows.where("e is not null").groupBy("label", "e").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    points = materialize(points.select(F.monotonically_increasing_id().alias("point"), F.size("e").alias("dim"), "*"), "points")
    coded = materialize(_coded(points, tables, hashes, probes, seed), "coded")

    entry = F.posexplode("codes").alias("p", "code")
    entries = coded.select("point", "label", "dim", entry)
    bucket = ["label", "dim", "table", "code"]
    entries = entries.withColumn("table", F.floor(F.col("p") / probes).cast("int")).select("point", *bucket).distinct()
    held = entries.groupBy(bucket).agg(F.count("*").alias("held"), F.min("point").alias("bucket")).where("held > 1")
    shared = entries.join(held, bucket).withColumn("blocks", F.ceil(F.col("held") / BLOCK)).withColumn(
        "block", F.pmod(F.xxhash64("point"), F.col("blocks"))
    )
    dealt = shared.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "point", "bucket", "table", "code", "dim", "block",
        F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"),
    )
    cells = dealt.join(coded.select("point", "copies", "unit", "codes"), "point").select(
        "bucket", "table", "code", "lo", "hi", "block", "point", "copies", "unit", "codes", "dim"
    )
    # the smallest member and the table and code name a bucket of one label and length
    key = ["bucket", "table", "code", "lo", "hi"]
    found = materialize(_verified(cells.repartition(*key).sortWithinPartitions(*key), cosine, tables, probes), "found")

    root = components(found.select(F.col("point").alias("a"), F.col("other").alias("b")))
    links = found.groupBy("point").agg(F.sum("links").alias("links"))
    of_point = (
        points.select("point", "label", "e", "least", "copies").join(links, "point", "left")
        .join(root, points["point"] == root["node"], "left")
        .select("label", "e", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "point").alias("root"))
    )
    of_point = materialize(of_point, "linked")
    least = of_point.groupBy("root").agg(F.min("least").alias("component"))
    named = of_point.join(least, "root").select("label", "e", "n_links", "component")
    out = rows.join(named, ["label", "e"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component")).alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
