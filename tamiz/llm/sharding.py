"""Shards of nearly equal bytes by sampled splitters, as DataFrame functions only.

Records are ordered by (digest of the text, id, row): equal texts stand together, whatever their number.

1. A sample of that order is drawn in which a record counts by its size. Every PER_RANGE-th sample is
   a splitter, so the ranges between splitters hold about the same bytes.
2. Every record finds its range by a binary search in the splitters of its digest's first digits.
   A range that holds more than twice its share of bytes and rows is overfull (one text may fill it,
   or many short ones): it is sampled again by itself and subdivided.
3. Inside a range, which is a bounded part of the table, records are ranked; the ranges' exact sums
   give each record its place and its first byte in the whole order.
4. A shard is a stretch of that order: a record belongs to the shard that its middle byte falls in.
   A cut inside a group of equal texts moves to the group's nearer end when the group is small.

The driver sees the splitters, sums of ranges and cuts, at most MOST_RANGES * PER_RANGE rows or so.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.runtime import materialize

#: Rows that a range holds on average, the number of ranges where they grow instead, samples for one range.
ROWS_IN_RANGE, MOST_RANGES, PER_RANGE = 400, 2048, 16
#: Bytes that a record has beside its text.
OVERHEAD = 16
#: Leading digits of the digest by which splitters are found.
DIGITS = 3

_AT = "array<struct<key_: string, id_: bigint, row_: bigint>>"
_KEY = ["key_", "id_", "row_"]


def _below(at: Column, most: int, value: Column) -> Column:
    """How many of the at most ``most`` entries of the ascending array ``at`` are no larger than ``value``."""
    steps = [1 << j for j in reversed(range(max(1, most.bit_length())))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda found, step: F.when(F.get(at, found + step - 1) <= value, found + step).otherwise(found),
    )


def _table(rows: DataFrame, entries: list[dict], fields: str) -> DataFrame:
    """A table of a few rows known to the driver."""
    parsed = F.from_json(F.lit(json.dumps(entries)), f"array<struct<{fields}>>")
    return rows.sparkSession.range(1).select(F.inline(parsed))


def _drawn(weight: Column, seed: int) -> Column:
    """How often a record is drawn: ``weight`` on average, by a hash of its row."""
    unit = F.pmod(F.xxhash64("row_", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(weight + unit).cast("int")


def _ranges(rows: DataFrame, n: int, total: int) -> tuple[DataFrame, int]:
    """The rows with their range ``range_``, and how many ranges were asked for."""
    wanted = min(MOST_RANGES, max(1, -(-n // ROWS_IN_RANGE)))
    drawn = rows.select(*_KEY, _drawn(F.col("size_") * (wanted * PER_RANGE / total), 1).alias("times")).where("times > 0")
    splitters, held = [], 0
    for r in drawn.orderBy(*_KEY).collect():
        held += r["times"]
        if held >= PER_RANGE:
            splitters.append({k: r[k] for k in _KEY})
            held %= PER_RANGE
    cells, base, most = [], 0, 1
    for i in range(16**DIGITS):
        cell = f"{i:0{DIGITS}x}"
        own = []
        while base + len(own) < len(splitters) and splitters[base + len(own)]["key_"].startswith(cell):
            own.append(splitters[base + len(own)])
        cells.append({"cell_": cell, "base": base, "at": own})
        base, most = base + len(own), max(most, len(own))
    lookup = _table(rows, cells, f"cell_: string, base: int, at: {_AT}")
    found = rows.withColumn("cell_", F.substring("key_", 1, DIGITS)).join(F.broadcast(lookup), "cell_")
    return found.select(*rows.columns, (F.col("base") + _below(F.col("at"), most, F.struct(*_KEY))).alias("range_")), wanted


def _subdivided(rows: DataFrame, wanted: int, n: int, total: int) -> DataFrame:
    """The rows with the part ``part_`` of their range; ranges that are not overfull are one part."""
    sums = rows.groupBy("range_").agg(F.sum("size_").alias("bytes"), F.count("*").alias("rows")).collect()
    load = {r["range_"]: wanted * (r["bytes"] / total + r["rows"] / n) / 2 for r in sums}
    over = [
        {"range_": r["range_"], "bytes": r["bytes"], "rows": r["rows"], "parts": int(load[r["range_"]]) + 1}
        for r in sums if load[r["range_"]] > 2
    ]
    if not over:
        return rows.withColumn("part_", F.lit(0))
    full = _table(rows, over, "range_: int, bytes: bigint, rows: bigint, parts: int")
    share = (F.col("size_") / F.col("bytes") + 1 / F.col("rows")) / 2
    drawn = (
        rows.join(F.broadcast(full), "range_")
        .withColumn("times", _drawn(share * F.col("parts") * PER_RANGE, 2)).where("times > 0")
        .groupBy("range_").agg(F.sort_array(F.flatten(F.collect_list(F.array_repeat(F.struct(*_KEY), F.col("times"))))).alias("drawn"))
    )
    at = drawn.select("range_", F.filter("drawn", lambda x, i: i % PER_RANGE == PER_RANGE - 1).alias("at"))
    at = materialize(at, "splitters")
    most = at.agg(F.max(F.size("at"))).first()[0] or 1
    return rows.join(F.broadcast(at), "range_", "left").select(
        *rows.columns, F.coalesce(F.when(F.size("at") > 0, _below(F.col("at"), most, F.struct(*_KEY))), F.lit(0)).alias("part_")
    )


def _placed(rows: DataFrame) -> DataFrame:
    """The rows with their number ``idx_`` and their first byte ``start_`` in the whole order."""
    inside = Window.partitionBy("range_", "part_").orderBy(*_KEY)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("range_", "part_").agg(F.sum("size_").alias("bytes"), F.count("*").alias("rows"))
    earlier = Window.orderBy("range_", "part_").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    offsets = sums.select(
        "range_", "part_",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes0"), F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows0"),
    )
    ranked = rows.select(
        "*", (F.row_number().over(inside) - 1).alias("idx_"), F.coalesce(F.sum("size_").over(before), F.lit(0)).alias("start_")
    )
    return ranked.join(F.broadcast(offsets), ["range_", "part_"]).select(
        *_KEY, "size_", "crc_", (F.col("idx_") + F.col("rows0")).alias("idx_"), (F.col("start_") + F.col("bytes0")).alias("start_")
    )


def _cuts(rows: DataFrame, shards: int, total: int, whole: float) -> list[int]:
    """The number of the first record of each shard but the first."""
    of = F.least(F.expr(f"((2 * start_ + size_) * {shards}) div {2 * total}"), F.lit(shards - 1))
    held = {r["shard"]: r["n"] for r in rows.groupBy(of.alias("shard")).agg(F.count("*").alias("n")).collect()}
    cuts, first = [], 0
    for i in range(shards - 1):
        first += held.get(i, 0)
        cuts.append(first)
    beside = {x for c in cuts for x in (c - 1, c)}
    key = {r["idx_"]: r["key_"] for r in rows.where(F.col("idx_").isin(sorted(beside))).select("idx_", "key_").collect()}
    inside = {key[c] for c in cuts if c in key and key.get(c - 1) == key[c]}
    if not inside:
        return cuts
    groups = rows.where(F.col("key_").isin(sorted(inside))).groupBy("key_").agg(
        F.min("idx_").alias("first"), F.count("*").alias("n"), F.min("start_").alias("start"), F.sum("size_").alias("bytes")
    )
    group = {r["key_"]: r for r in groups.collect() if r["bytes"] * shards <= whole * total}
    for i, c in enumerate(cuts):
        g = group.get(key.get(c)) if key.get(c - 1) == key.get(c) else None
        if g is not None:
            before = (2 * g["start"] + g["bytes"]) * shards < 2 * total * (i + 1)  # its middle lies before the cut
            cuts[i] = g["first"] + g["n"] if before else g["first"]
    return cuts


def assign(
    docs: DataFrame, shards: int = 40, whole: float = 0.02, carry: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard[, record]) of every row of ``docs``.

    ``size`` is the text's UTF-8 bytes and OVERHEAD; ``text_crc32`` is of the same bytes. The law is
    ``bytes``: each of the shards 0 to ``shards - 1`` holds 1 / ``shards`` of all bytes, give or take half a
    record and half a group at either end. ``slot`` numbers a shard's rows from 0 without gaps, in the
    order of (md5 of the text, id). Equal texts stand in neighbouring slots; a group of at most ``whole``
    of a shard's bytes is never cut. ``grown_shard`` is null, as it says nothing under this law. The
    sample decides how the work is dealt out, not the result.

    The columns named in ``carry`` come along in the struct ``record``, so their names cannot clash; no
    other column than the id, the text and these is read. A null text is an empty one: no bytes, crc32 0,
    one group with empty texts. Ids are cast to long; a null id comes first in its group. Repeated rows
    are rows and get a slot each. Fewer rows than shards leave shards empty; an empty table gives an
    empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialize(
        docs.select(
            F.monotonically_increasing_id().alias("row_"), F.col(id_col).cast("long").alias("id_"),
            (F.octet_length(text) + OVERHEAD).cast("long").alias("size_"), F.crc32(text.cast("binary")).alias("crc_"),
            F.md5(text.cast("binary")).alias("key_"), *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("record")] if carry else []),
        ), "records",
    )
    narrow = rows.select(*_KEY, "size_", "crc_")
    n, total = narrow.agg(F.count("*"), F.sum("size_")).first()
    if n:
        ranged, wanted = _ranges(narrow, n, total)
        ranged = materialize(ranged, "ranges")
        placed = materialize(_placed(_subdivided(ranged, wanted, n, total)), "places")
        cuts = _cuts(placed, shards, total, whole)
    else:
        placed, cuts = narrow.withColumns({"idx_": F.lit(0), "start_": F.lit(0)}), [0] * (shards - 1)
    shard = _below(F.array(*[F.lit(c).cast("long") for c in cuts]), len(cuts), F.col("idx_").cast("long")) if cuts else F.lit(0)
    named = placed.withColumn("shard", shard.cast("int"))
    first = F.get(F.array(*[F.lit(c).cast("long") for c in [0, *cuts]]), F.col("shard"))
    out = named.select(
        "row_", F.col("id_").alias("doc_id"), F.col("size_").alias("size"), F.col("crc_").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", (F.col("idx_") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
    if carry:
        out = out.join(rows.select("row_", "record"), "row_")
    return out.drop("row_")


def write(docs: DataFrame, path: str, shards: int = 40, **options) -> DataFrame:
    """Write the whole rows as Parquet, a folder for each shard, its files in order of ``slot``; returns the written table.

    A shard is written by as many tasks as its bytes call for. The input's columns are in the struct ``record``.
    """
    out = assign(docs, shards, carry=tuple(docs.columns), **options).select("shard", "slot", "record")
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.parquet(path)
