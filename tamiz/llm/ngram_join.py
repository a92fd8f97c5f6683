"""Exact Jaccard join of documents on word shingles, by a token-group matrix.

1. Every document becomes a set of 64-bit shingle hashes. Documents with equal sets are one
   *set* from here on, told apart by a 128-bit fingerprint of the set.
2. Similar sets are partitioned into groups: each set is compared with the most typical set of
   each of its min-hash buckets and joins the most typical one with enough equal min-hashes.
3. The matrix has a row for each token block and a column for each group. Two sets above the
   threshold differ in at most ``H`` tokens, so when the token space is cut into more than ``H``
   blocks, at least one block is equal in both (``blocks``). A set is a query for a group that
   shares enough blocks with it for their sizes; no other pair of groups can hold a link.
4. For groups of several sets the union of their tokens is stored. The overlap of query and
   union bounds the overlap with every member; groups below the bound stay closed.
5. The members of a group are compared with each other and with the queries that opened it, in
   cells of two blocks of rows. A cell counts common tokens by a product of token matrices and
   returns which of its rows belong together, not pairs.

No step lists the pairs inside a group, and copies of one text are never paired at all.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.runtime import materialize

from .cells import groups, joined
from .components import components, small
from .words import Words, batches, mix, signed, windows
from .worker import trimmed

_U = np.uint64
_FACTOR = 0xD6E8FEB86659FD93
#: Odd multipliers of the min-hashes.
MIN_HASHES = 16
_TURN = np.random.default_rng(11).integers(1, 1 << 62, MIN_HASHES, dtype=np.uint64) * _U(2) + _U(1)
#: Blocks above the needed number at least; sets with at most the spare number of empty blocks need not send them.
SPARE = 3
#: Standard deviations by which the spare blocks exceed the expected number of empty ones.
SPARE_DEVIATIONS = 3
#: Low bits that block signatures do without: zeros next to a row's other zeros, so that shuffles store six bytes of eight.
BLOCK_SHIFT = 16
#: Equal min-hashes that let a set join the group of a typical set; any partition gives the same links.
RESEMBLES = 6
#: Bits of a fingerprint that token blocks do without.
KEY_SHIFT = 24
#: A group's token union is stored in parts of at most about so many tokens.
UNION_PART = 1 << 16
#: A block of a group's members or queries; token columns multiplied at a time.
BLOCK_TOKENS, BLOCK_SETS, COLUMNS = 1 << 19, 256, 8192


def levels(num: int, den: int, largest: int) -> list[int]:
    """Lower ends of the size levels; partners of a set lie in its own or a neighbouring level."""
    ends = [1]
    while ends[-1] <= largest:
        ends.append(max(ends[-1] + 1, ends[-1] * den // num + 1))
    return ends


def differences(ends: list[int], level: int, num: int, den: int) -> int:
    """The largest symmetric difference of pairs whose smaller set is in ``level``. Zero: only equal sets.

    Sizes a <= b with b <= a * den / num and intersection >= num / den * union give a
    difference of at most (den - num) / (den + num) * (a + b).
    """
    a = ends[level + 1] - 1
    return (den - num) * (a + a * den // num) // (den + num)


@functools.cache
def spare(least: int, differ: int) -> int:
    """Blocks above ``differ + 1``, so many that sets of ``least`` tokens hardly ever have more empty ones.

    Empty blocks are the same for all sets of a level: sent, each of them pairs a share of all sets. Where twice
    the blocks would not do, SPARE.
    """
    for n in range(SPARE, max(SPARE, differ) + 1):
        count = differ + 1 + n
        load = least / count
        empty = count * math.exp(-load)
        if n + 1 > empty + SPARE_DEVIATIONS * math.sqrt(empty * (1 - (1 + load) * math.exp(-load))):
            return n
    return SPARE


def blocks(tokens: np.ndarray, ends: list[int], num: int, den: int) -> np.ndarray:
    """Signatures of the token blocks of one set, for its own level and the one below.

    ``tokens`` is sorted; a block is a range of hash values. Of ``differ + 1 + spare`` blocks at
    least ``1 + spare`` are equal in a pair above the threshold. A set with at most ``spare`` empty
    blocks can leave them out: one of the equal ones is then not empty.
    """
    own = int(np.searchsorted(ends, len(tokens), side="right")) - 1
    mixed = mix(tokens + _U(1))
    out = []
    for level in (own, own - 1):
        if level < 0 or not (differ := differences(ends, level, num, den)):
            continue
        extra = spare(ends[level], differ)
        count = differ + 1 + extra
        block = ((tokens >> _U(32)) * _U(count)) >> _U(32)
        heads = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        sums = np.add.reduceat(mixed, heads)
        where = block[heads] + _U(level << 40)
        out.append(mix(sums ^ mix(where + _U(1 << 20))))
        if count - len(heads) > extra:
            empty = np.setdiff1d(np.arange(count, dtype=np.uint64), block[heads]) + _U(level << 40)
            out.append(mix(mix(empty + _U(1 << 20)) ^ _U(0x5EED)))
    return np.concatenate(out) >> _U(BLOCK_SHIFT) << _U(BLOCK_SHIFT) if out else np.zeros(0, dtype=np.uint64)


def token_sets(text: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than a shingle are one token."""
    for i, j, data, offsets in batches(text):
        w = Words(data, offsets, lower=True)
        runs = mix(windows(w.hash, words, _FACTOR))
        for k in range(j - i):
            a, b = int(w.first[k]), int(w.first[k + 1])
            if b - a >= words:
                yield np.unique(runs[a : b - words + 1])
            elif b > a:
                short = windows(w.hash[a:b], b - a, _FACTOR)
                yield mix(short ^ _U(0xC0FFEE + b - a))
            else:
                yield np.zeros(0, dtype=np.uint64)


def fingerprint(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart, as two signed numbers."""
    d = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _index(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n, k1, k2, mins) of every row; an empty set has no k1, k2 and mins."""

    def run(parts):
        for batch in parts:
            n, k1, k2, mins = [], [], [], []
            for tokens in token_sets(batch.column(1), words):
                key = fingerprint(tokens) if len(tokens) else (None, None)
                n.append(len(tokens))
                k1.append(key[0])
                k2.append(key[1])
                mins.append(signed(np.array([(tokens * t).min() for t in _TURN])) if len(tokens) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(mins, pa.list_(pa.int64()))],
                names=["doc_id", "n", "k1", "k2", "mins"],
            )

    return docs.mapInArrow(trimmed(run), "doc_id long, n long, k1 long, k2 long, mins array<long>")


def _blocks(docs: DataFrame, words: int, num: int, den: int, largest: int) -> DataFrame:
    """(block, key) of every row, one row for each block; of equal sets in a batch one sends its blocks.

    ``key`` is the upper part of k1, which most often tells sets apart.
    """
    ends = levels(num, den, largest)

    def run(parts):
        for batch in parts:
            found, keys, held, seen = [], [], 0, set()
            for tokens in token_sets(batch.column(0), words):
                key = fingerprint(tokens) if len(tokens) else None
                if key is None or key in seen:
                    continue
                seen.add(key)
                found.append(blocks(tokens, ends, num, den))
                keys.append(np.full(len(found[-1]), key[0] >> KEY_SHIFT, dtype=np.int64))
                held += len(found[-1])
                if held > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(found))), pa.array(np.concatenate(keys))], names=["block", "key"])
                    found, keys, held = [], [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(found))), pa.array(np.concatenate(keys))], names=["block", "key"])

    return docs.select("text").mapInArrow(trimmed(run), "block long, key long")


def _shared(rows: DataFrame) -> DataFrame:
    """(block, key) of the ``rows`` (block, key) whose block is in another set too, each once.

    One pass over rows sorted by block: neighbours are compared, nothing is held but the last row.
    """

    def run(parts):
        last, told = None, True  # the last row, and whether it went out
        for batch in parts:
            if not batch.num_rows:
                continue
            block, k = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if last is not None:
                block, k = np.concatenate(([last[0]], block)), np.concatenate(([last[1]], k))
            first = np.concatenate(([True], (block[1:] != block[:-1]) | (k[1:] != k[:-1])))
            block, k = block[first], k[first]
            same = block[1:] == block[:-1]
            keep = np.concatenate(([False], same)) | np.concatenate((same, [False]))
            if last is not None and told:
                keep[0] = False
            told = bool(keep[-1]) or (len(block) == 1 and last is not None and told)
            last = (block[-1], k[-1])
            yield pa.RecordBatch.from_arrays([pa.array(block[keep]), pa.array(k[keep])], names=["block", "key"])

    parts = rows.repartition("block").sortWithinPartitions("block", "key")
    return parts.mapInArrow(trimmed(run), "block long, key long")


def _keyed(docs: DataFrame, words: int) -> DataFrame:
    """(k1, k2, tokens) of the rows of ``docs`` that have a word."""

    def run(parts):
        for batch in parts:
            sets = list(token_sets(batch.column(0), words))
            keep = [i for i, t in enumerate(sets) if len(t)]
            keys = [fingerprint(sets[i]) for i in keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in keys], pa.int64()), pa.array([k for _, k in keys], pa.int64()),
                 pa.array([signed(sets[i]) for i in keep], pa.list_(pa.int64()))],
                names=["k1", "k2", "tokens"],
            )

    return docs.select("text").mapInArrow(trimmed(run), "k1 long, k2 long, tokens array<long>")


def _tokens(docs: DataFrame, words: int, wanted: DataFrame) -> DataFrame:
    """(rep, tokens, ...) of the wanted (rep, doc_id, k1, k2, ...), one row for each; repeated rows give repeated sets.

    The texts of the wanted ids are read again; sets that only rows with a null id have are found by their
    fingerprint among those. Ids alone are broadcast, if at all.
    """
    rest = [c for c in wanted.columns if c not in ("rep", "doc_id", "k1", "k2")]
    names = ["rep", "tokens", *rest]

    def run(parts):
        for batch in parts:
            keep, packed = [], []
            wants = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            for i, (want, tokens) in enumerate(zip(wants, token_sets(batch.column(0), words), strict=True)):
                if len(tokens) and fingerprint(tokens) == want:
                    keep.append(i)
                    packed.append(signed(tokens))
            kept = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([kept.column(3), pa.array(packed, pa.list_(pa.int64())), *kept.columns[4:]], names=names)

    schema = T.StructType().add("rep", "long").add("tokens", T.ArrayType(T.LongType()))
    for c in rest:
        schema = schema.add(wanted.schema[c])
    known = wanted.where("doc_id is not null").withColumnRenamed("doc_id", "wanted_id")
    ids = known.select(F.col("wanted_id").alias("doc_id")).distinct()
    rows = docs.join(small(ids), "doc_id", "left_semi").join(known, F.col("doc_id") == F.col("wanted_id"))
    out = rows.select("text", "k1", "k2", "rep", *rest).mapInArrow(trimmed(run), schema)
    unnamed = wanted.where("doc_id is null").drop("doc_id")
    if not unnamed.isEmpty():
        lost = _keyed(docs.where("doc_id is null"), words).join(small(unnamed.select("k1", "k2")), ["k1", "k2"], "left_semi")
        out = out.unionByName(unnamed.join(lost.dropDuplicates(["k1", "k2"]), ["k1", "k2"]).select("rep", "tokens", *rest))
    return out


def _unions(rows: DataFrame) -> DataFrame:
    """(g, part, union) of ``rows`` (g, parts, tokens): the tokens of each group, dealt to its parts by remainder.

    Tokens of one group are united in the batches first. A part gets at most its share of all
    tokens of the group, about UNION_PART.
    """

    def run(parts):
        for batch in parts:
            g, n_parts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            lists = batch.column(2)
            values = lists.flatten().to_numpy()
            owner = np.repeat(np.arange(len(g)), np.diff(lists.offsets.to_numpy()))
            part = np.mod(values, n_parts[owner])
            order = np.lexsort((values, part, g[owner]))
            gs, part, values = g[owner][order], part[order], values[order]
            new = np.ones(len(values), dtype=bool)
            new[1:] = (gs[1:] != gs[:-1]) | (part[1:] != part[:-1]) | (values[1:] != values[:-1])
            gs, part, values = gs[new], part[new], values[new]
            heads = np.flatnonzero(np.concatenate(([True], (gs[1:] != gs[:-1]) | (part[1:] != part[:-1])))) if len(gs) else np.zeros(0, dtype=np.int64)
            cuts = pa.array(np.append(heads, len(values)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(gs[heads]), pa.array(part[heads]), pa.ListArray.from_arrays(cuts, pa.array(values))], names=["g", "part", "tokens"]
            )

    united = rows.select("g", "parts", "tokens").mapInArrow(trimmed(run), "g long, part long, tokens array<long>")
    return united.groupBy("g", "part").agg(F.array_distinct(F.flatten(F.collect_list("tokens"))).alias("union"))


def _overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets in ``a`` with all in ``b``, by token matrices."""
    out = np.zeros((len(a), len(b)), dtype=np.float32)
    common = np.intersect1d(np.concatenate(a), np.concatenate(b))
    at = [np.searchsorted(common, x) for x in (*a, *b)]
    hit = [i[(i < len(common)) & (common[np.minimum(i, len(common) - 1)] == x)] if len(common) else i[:0] for i, x in zip(at, (*a, *b), strict=True)]
    for lo in range(0, len(common), COLUMNS):
        m = np.zeros((len(hit), min(COLUMNS, len(common) - lo)), dtype=np.float32)
        for row, i in enumerate(hit):
            m[row, i[np.searchsorted(i, lo) : np.searchsorted(i, lo + COLUMNS)] - lo] = 1
        out += m[: len(a)] @ m[len(a) :].T
    return out


def _compared(cells: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): for each set that has a link in its cell, a set of the same class.

    ``cells`` has (g, lo, hi, block, member, rep, tokens). Blocks lo and hi are compared, unless both
    hold only queries.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in groups(parts, 3):
            lo, hi = cell.column(1)[0].as_py(), cell.column(2)[0].as_py()
            block, rep = cell.column(3).to_numpy(), cell.column(5).to_numpy()
            lists = cell.column(6).combine_chunks()
            values, cuts = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
            sets = [values[x:y] for x, y in zip(cuts, cuts[1:], strict=False)]
            first, second = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
            if not len(first) or not len(second):
                continue
            size = np.diff(cuts)
            both = _overlaps([sets[i] for i in first], [sets[i] for i in second])
            close = den * both >= num * (size[first][:, None] + size[second][None, :] - both)
            if lo == hi:
                close = np.triu(close, 1)
            a, b = np.nonzero(close)
            if len(a):
                least = joined(len(rep), first[a], second[b])
                moved = np.flatnonzero(least != np.arange(len(rep)))
                yield pa.RecordBatch.from_arrays([pa.array(rep[moved]), pa.array(rep[least[moved]])], names=["a", "b"])

    return cells.mapInArrow(trimmed(run), "a long, b long")


def _cells(docs: DataFrame, words: int, sets: DataFrame, opened: DataFrame) -> DataFrame:
    """The cells of every group with several sets or with queries, see ``_compared``.

    Members take the first blocks of their group, queries the following ones; blocks have about
    BLOCK_TOKENS tokens or BLOCK_SETS sets.
    """
    size = F.ceil(F.greatest(F.sum("n") / BLOCK_TOKENS, F.count("*") / BLOCK_SETS))
    queries = opened.groupBy("g").agg(size.alias("query_blocks"))
    held = sets.groupBy("g").agg(F.count("*").alias("held"), size.alias("blocks")).join(queries, "g", "left")
    held = held.where("held > 1 or query_blocks is not null").select("g", "blocks", F.coalesce("query_blocks", F.lit(0)).alias("query_blocks"))
    name = ["rep", "doc_id", "k1", "k2"]
    members = sets.select("g", *name).join(held, "g").select(
        "g", *name, F.pmod(F.xxhash64("rep"), F.col("blocks")).alias("block"), F.lit(True).alias("member"), (F.col("blocks") + F.col("query_blocks")).alias("others")
    )
    asking = opened.select("g", "rep").join(held, "g").join(sets.select(*name), "rep").select(
        "g", *name, (F.col("blocks") + F.pmod(F.xxhash64("rep"), F.col("query_blocks"))).alias("block"), F.lit(False).alias("member"), F.col("blocks").alias("others")
    )
    rows = members.unionByName(asking).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1)))
    place = F.struct("g", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"), "block", "member").alias("cell")
    wanted = materialize(rows.select(*name, place).groupBy(*name).agg(F.collect_list("cell").alias("cells")), "wanted")
    cells = _tokens(docs, words, wanted).select("rep", "tokens", F.explode("cells").alias("c")).select("c.*", "rep", "tokens")
    return cells.repartition("g", "lo", "hi").sortWithinPartitions("g", "lo", "hi")


def _fits(n_a: str, n_b: str, num: int, den: int):
    """Sizes that allow the threshold."""
    return (F.col(n_a) * den >= F.col(n_b) * num) & (F.col(n_b) * den >= F.col(n_a) * num)


def _least_shared(ends: list[int], num: int, den: int, n: str, lo: str, hi: str):
    """Blocks that a set of size ``n`` shares with a set of a size from ``lo`` to ``hi`` above the threshold.

    All blocks for the smaller one's level, without the spare ones, less the largest difference.
    """
    low = F.greatest(F.col(lo), F.ceil(F.col(n) * num / den))
    high = F.least(F.col(hi), F.floor(F.col(n) * den / num))
    level = F.size(F.filter(F.array(*(F.lit(e) for e in ends)), lambda e: e <= F.least(F.col(n), low)))
    needed = F.array(*(F.lit(d + 1 if (d := differences(ends, k, num, den)) else 0) for k in range(len(ends) - 1)))
    differ = F.floor((F.col(n) + high) * (den - num) / (den + num))
    return F.greatest(F.lit(1), F.element_at(needed, level) - differ)


def classes(
    docs: DataFrame, words: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    Two rows link when den * |A & B| >= num * |A | B| for their sets of ``words``-word shingles
    over A-Z lower-cased text; component_id is the smallest id reachable by links, itself
    included. Defaults: five words, similarity 0.8.

    Reads only the two named columns, so extra columns cannot clash. A null or blank text has an
    empty set, links with nothing and is its own component. Repeated rows and equal texts are one
    set and so one component. A row with a null id takes part in links like any other but gives no id: its
    component is the smallest known id, or null. Rows with one id and different texts are sets of their
    own. An empty table gives an empty result. Sets are
    told apart by 128-bit fingerprints and tokens by 64-bit hashes.
    """
    return _classes(docs, words, num, den, id_col, text_col).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _classes(docs: DataFrame, words: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, k1, k2, root, component_id): root names the class of a set, also of one without an id."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    index = materialize(_index(docs, words), "index")
    narrow = index.select("doc_id", "n", "k1", "k2")
    distinct = index.where("k1 is not null").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("mins").alias("mins")
    )
    sets = materialize(distinct.select(F.monotonically_increasing_id().alias("rep"), "*"), "distinct")
    largest = sets.agg(F.max("n")).first()[0] or 1
    ends = levels(num, den, largest)

    # 2. groups of similar sets: the most typical set of each min-hash bucket
    # buckets hold numbers only; the min-hashes are fetched once for each pair of a set and a lead
    bucket = sets.select("rep", F.posexplode("mins").alias("slot", "value"))
    held = bucket.groupBy("slot", "value").agg(F.count("*").alias("held")).where("held > 1")
    shared = materialize(bucket.join(held, ["slot", "value"]), "buckets")
    typical = shared.groupBy("rep").agg(F.sum(F.log2("held")).alias("weight"))
    shared = shared.join(typical, "rep")
    lead = shared.groupBy("slot", "value").agg(F.max(F.struct("weight", "rep")).alias("lead"))
    pairs = shared.join(lead, ["slot", "value"]).where(F.col("rep") != F.col("lead.rep")).select("rep", "lead").distinct()
    mins = sets.select("rep", "mins")
    both = pairs.join(mins, "rep").join(mins.select(F.col("rep").alias("lead_rep"), F.col("mins").alias("lead_mins")), F.col("lead.rep") == F.col("lead_rep"))
    equal = F.size(F.filter(F.zip_with("mins", "lead_mins", lambda x, y: x == y), lambda e: e))
    group = (
        both.where(equal >= RESEMBLES).groupBy("rep").agg(F.max("lead").alias("lead"))
        .select(F.col("rep").alias("node"), F.col("lead.rep").alias("root"))
    )
    name = ["rep", "doc_id", "k1", "k2", "n"]
    sets = sets.select(*name).join(group, sets.rep == group.node, "left").select(*name, F.coalesce("root", "rep").alias("g"))
    several = sets.groupBy("g").agg((F.count("*") > 1).alias("several"))
    sets = materialize(sets.join(several, "g").select(*name, "g", "several"), "grouped")

    # 3. matrix of token blocks and groups, rows that occur in one set only left out
    rows = _shared(_blocks(docs, words, num, den, largest))
    # a set that shares its key with another one brings both: too many candidates, never too few
    keyed = sets.select(F.shiftright("k1", KEY_SHIFT).alias("key"), "rep", "n", "g", "several")
    matrix = materialize(rows.join(keyed, "key").drop("key"), "matrix")
    # groups hold most shared rows alone
    between = matrix.groupBy("block").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).where("lo < hi").select("block")
    matrix = materialize(matrix.join(between, "block"), "between")
    columns = matrix.groupBy("block", "g", "several").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    visits = (
        matrix.select("block", "rep", "n", F.col("g").alias("own"))
        .join(columns, "block").where("own > g")
        .where((F.col("n") * den >= F.col("lo") * num) & (F.col("hi") * den >= F.col("n") * num))
        .groupBy("rep", "n", "own", "g", "several")
        .agg(F.count("*").alias("shared"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .where(F.col("shared") >= _least_shared(ends, num, den, "n", "lo", "hi"))
    )
    visits = materialize(visits, "visits")

    # 4. bound by the union of the group's tokens
    visited = visits.select("g").distinct()
    members = sets.where("several").join(visited, "g", "left_semi").select("rep")
    wanted = members.unionByName(visits.where("several").select("rep")).distinct().join(sets.select("rep", "doc_id", "k1", "k2"), "rep")
    tokens = materialize(_tokens(docs, words, materialize(wanted, "wanted")), "tokens")
    parts = sets.where("several").groupBy("g").agg(F.ceil(F.sum("n") / UNION_PART).alias("parts")).join(visited, "g", "left_semi")
    parts = materialize(parts, "parts")
    union = _unions(sets.select("rep", "g").join(parts, "g").join(tokens, "rep"))
    asks = visits.where("several").select("rep", "n", "g").join(parts, "g").select(
        "rep", "n", "g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    )
    overlap = asks.join(tokens, "rep").join(union, ["g", "part"]).select(
        "rep", "n", "g", F.size(F.array_intersect("tokens", "union")).alias("both")
    )
    open_several = overlap.groupBy("rep", "n", "g").agg(F.sum("both").alias("overlap")).where(F.col("overlap") * den >= F.col("n") * num)
    opened = open_several.select("rep", "n", "g").unionByName(visits.where("not several").select("rep", "n", "g"))

    # 5. compare the members of groups with each other and with the queries
    links = _compared(_cells(docs, words, sets, materialize(opened, "opened")), num, den)
    merged = components(links)
    of_set = sets.join(merged, sets.rep == merged.node, "left").select("k1", "k2", "doc_id", F.coalesce("root", "rep").alias("root"))
    least = of_set.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = of_set.join(least, "root").select("k1", "k2", "root", "component_id")
    return narrow.join(named, ["k1", "k2"], "left").select(
        "doc_id", "n", "k1", "k2", "root",
        F.when(F.col("k1").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _fingerprinted(docs: DataFrame, words: int) -> DataFrame:
    """The rows of ``docs`` with the fingerprint (k1_, k2_) of their set."""
    place = docs.columns.index("text")
    names = [f"c{i}" for i in range(len(docs.columns))] + ["k1_", "k2_"]

    def run(parts):
        for batch in parts:
            keys = [fingerprint(t) if len(t) else (None, None) for t in token_sets(batch.column(place).cast(pa.string()), words)]
            added = [pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=names)

    schema = docs.toDF(*names[:-2]).schema.add("k1_", "long").add("k2_", "long")
    return docs.mapInArrow(trimmed(run), schema).toDF(*docs.columns, "k1_", "k2_")


def one_of_each(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) without all but one of each class, columns as they were.

    The row with the smallest id of its class stays. Where rows share that id, one row stays, and a class
    that has only null ids keeps one row; rows without a word all stay.
    """
    found = materialize(_classes(docs, words, num, den, "doc_id", "text"), "classes")
    # of each class the smallest id, and of several sets with that id one
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "k1", "k2")
    first = found.where("k1 is not null").groupBy("root").agg(F.min(order).alias("first")).select("first.*")
    often = found.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    blank = found.where("k1 is null and doc_id is not null").select("doc_id")
    once = materialize(
        first.where("not unnamed").select("doc_id").unionByName(blank).distinct().join(often, "doc_id", "left_anti"), "kept"
    )
    docs_id = docs["doc_id"].cast("long")
    known = docs.join(small(once.withColumnRenamed("doc_id", "kept_id")), docs_id == F.col("kept_id"), "left_semi")
    # rows that share an id, or have none, are told apart by their fingerprints
    often = materialize(often, "often")
    shared = docs.join(small(often.withColumnRenamed("doc_id", "often_id")), docs_id == F.col("often_id"), "left_semi").unionByName(docs.where("doc_id is null"))
    keyed = _fingerprinted(shared, words)
    same = (
        keyed["doc_id"].cast("long").eqNullSafe(F.col("first_id")) & (keyed["k1_"] == F.col("first_k1")) & (keyed["k2_"] == F.col("first_k2"))
    )
    firsts = first.select(F.col("doc_id").alias("first_id"), F.col("k1").alias("first_k1"), F.col("k2").alias("first_k2"))
    kept = keyed.where("k1_ is not null").join(firsts, same, "left_semi").dropDuplicates(["doc_id", "k1_", "k2_"])
    kept = kept.unionByName(keyed.where("k1_ is null")).drop("k1_", "k2_")
    return known.unionByName(kept)
