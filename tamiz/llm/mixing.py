"""Mixing sources to target weights by Pfair scheduling.

Each source's rows are cut into blocks. In the ideal mix all sources flow at once, each at its weight out of the
weights of the sources that have not ended, so a source of weight w has poured ``min(n, w v)`` of its n
blocks when the level is v, and the stream is as long as their sum. Block i of the source starts to flow at level
``i / w`` and has ended at ``(i + 1) / w``; the length of the stream at these two levels, rounded down and
up, is the block's release and deadline.

Every slot takes the block with the earliest deadline among the released ones. The ideal mix fills every slot, so each
block finds a slot in its window, and at every point of the stream a source is less than one block from its target,
before and after any source ends. Levels are compared as exact fractions; there is no period and no rounding of weights.

The driver holds one row for each source and each block, never one for a row of the table: beyond MOST_BLOCKS blocks of
the usual size the blocks grow with the table instead.
"""

from __future__ import annotations

import heapq
from fractions import Fraction
from math import gcd, lcm

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamiz.runtime import materialize

#: Rows of a block at least, and the number of blocks beyond which blocks grow instead.
BLOCK_ROWS, MOST_BLOCKS = 64, 1 << 20
#: Rows of one source that are ranked together.
RANGE_ROWS = 20_000


def whole(weights: dict) -> dict:
    """The weights as whole numbers in the same proportions."""
    exact = {k: Fraction(w) for k, w in weights.items()}
    common = lcm(*(w.denominator for w in exact.values()))
    out = {k: int(w * common) for k, w in exact.items()}
    least = gcd(*out.values()) or 1
    return {k: w // least for k, w in out.items()}


def windows(blocks: dict, weights: dict) -> list[tuple]:
    """(release, deadline, key, i) of every block; ``blocks`` has the number of blocks of each key, ``weights`` are whole numbers."""
    ends = sorted((Fraction(n, weights[k]), n, weights[k]) for k, n in blocks.items())
    over, left = [0], [sum(weights[k] for k in blocks)]  # blocks of the keys that have ended, weights of the others
    for _, n, w in ends:
        over.append(over[-1] + n)
        left.append(left[-1] - w)
    out = []
    for k, n in blocks.items():
        w, s = weights[k], 0
        levels = []
        for i in range(n + 1):  # the stream at level i / w has length over + left * i / w
            while s < len(ends) and ends[s][0] * w <= i:
                s += 1
            levels.append((over[s] * w + left[s] * i, w))
        out += [(a // w, -(-b // w), k, i) for i, ((a, _), (b, _)) in enumerate(zip(levels, levels[1:], strict=False))]
    return out


def schedule(blocks: dict, weights: dict) -> list[tuple]:
    """(key, i, slot, release, deadline) of every block, earliest deadline first, equal ones by key."""
    todo = sorted(windows(blocks, weights), key=lambda x: x[0])
    names = {k: j for j, k in enumerate(sorted(blocks, key=str))}
    ready: list = []
    out, at = [], 0
    for slot in range(len(todo)):
        while at < len(todo) and todo[at][0] <= slot:
            release, deadline, k, i = todo[at]
            heapq.heappush(ready, (deadline, names[k], i, release, k))
            at += 1
        deadline, _, i, release, k = heapq.heappop(ready)
        out.append((k, i, slot, release, deadline))
    return out


def _ranked(rows: DataFrame, seed: int) -> DataFrame:
    """(id, key, rank): the place of each row in its source, in the order of a hash of the id.

    Rows are ranked inside ranges of the hash, about RANGE_ROWS each, and the rows before each
    range are added; no task holds a whole source.
    """
    total = rows.count()
    ranges = max(1, -(-total // RANGE_ROWS))
    rows = rows.withColumn("h", F.xxhash64("id", F.lit(seed))).withColumn(
        "range", F.floor((F.col("h") / 2.0**64 + 0.5) * ranges).cast("long")
    )
    sizes = rows.groupBy("key", "range").agg(F.count("*").alias("size"))
    before = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("key", "range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("key", "range").orderBy("h", "id")
    return rows.withColumn("n", F.row_number().over(inside)).join(sizes, ["key", "range"]).select(
        "id", "key", (F.col("before") + F.col("n") - 1).alias("rank")
    )


def temperature(counts: dict, alpha: float) -> dict:
    """Weights that are the sizes to the power ``alpha``: 1 keeps the mix, 0 makes it even."""
    return {k: Fraction(max(1, round(n**alpha * 2**20)), 2**20) for k, n in counts.items()}


def targets(counts: dict, weights: dict | None, alpha: float) -> dict:
    """The weight of each source in ``counts``, as whole numbers; those not in ``weights`` are scaled to the weights given."""
    given = {k: Fraction(w) for k, w in (weights or {}).items()}
    if any(w <= 0 for w in given.values()):
        raise ValueError("weights must be above zero")
    own = temperature(counts, alpha)
    named = [k for k in given if k in counts]
    scale = sum(given[k] for k in named) / sum(own[k] for k in named) if named else Fraction(1)
    return whole({k: given.get(k, w * scale) for k, w in own.items()})


def mix(
    docs: DataFrame, weights: dict | None = None, block_rows: int | None = None, alpha: float = 0.5, seed: int = 17,
    id_col: str = "doc_id", source_col: str = "source",
) -> DataFrame:
    """(doc_id, source, block, block_rows, slot, release, deadline, position) of every row of ``docs``.

    ``weights`` gives each source its target weight; sources it leaves out, or all without it, get
    their number of rows to the power ``alpha``, scaled to the weights given. Weights hold as given, however small,
    and there may be any number of sources. Rows go into blocks
    of ``block_rows`` of one source, in the order of a hash of the id; a source's last block can be
    shorter. Without it blocks have BLOCK_ROWS rows, or as many as make MOST_BLOCKS of the table. Sorted by
    ``position``, the rows are the stream: every prefix of
    slots holds a source's target to less than one block. No row is dropped or repeated: when
    a source has ended, the others keep their proportions.

    Reads only the two named columns, so extra columns cannot clash. Null is a source like any
    other. Null ids and repeated rows stay rows of their own; rows with equal ids have places
    next to each other. An empty table gives an empty result. A weight that is not above zero raises ValueError.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"))
    # a key that is never null
    rows = rows.select("id", F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")).alias("key"))
    counts = {r["key"]: r["n"] for r in rows.groupBy("key").agg(F.count("*").alias("n")).collect()}
    target = targets(counts, {"-" if k is None else f"={k}": w for k, w in (weights or {}).items()}, alpha)
    size = block_rows or max(BLOCK_ROWS, -(-sum(counts.values()) // MOST_BLOCKS))
    plan = schedule({k: -(-n // size) for k, n in counts.items()}, target)
    slots = materialize(spark.createDataFrame(plan, "key string, block long, slot long, release long, deadline long"), "slots")

    blocks = _ranked(rows, seed).select("id", "key", "rank", F.floor(F.col("rank") / size).alias("block"))
    return blocks.join(slots, ["key", "block"]).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("key") != "-", F.substring("key", 2, 2**31 - 1)).alias("source"),
        "block", F.lit(size).cast("long").alias("block_rows"), "slot", "release", "deadline",
        (F.col("slot") * size + F.col("rank") % size).alias("position"),
    )


def in_order(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` (doc_id, source, ...) as one stream, columns as they were, sorted by position.

    Rows with the same id and source stand together at the first of their places. Written as
    files, the parts follow one another in the order of the stream.
    """
    places = mix(docs, **options).groupBy("doc_id", "source").agg(F.min("position").alias("_position"))
    places = places.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), "_position")
    same = docs["doc_id"].cast("long").eqNullSafe(places["_id"]) & docs["source"].eqNullSafe(places["_source"])
    return docs.join(places, same).orderBy("_position").select(*(docs[c] for c in docs.columns))
