"""Exact top-k inner products by a three-phase uniform threshold.

Vectors are cut into ``lists`` ranges of components; each range gives a list of partial scores
and a total is the sum of one entry from each list. Rows and queries are packed into blocks, and
a (row block, query block) pair is one node.

1. Every node sends the ``k`` best entries of each of its lists, with their totals. The k-th best
   total of a query over all nodes is a safe cutoff: the answer is not below it.
2. The cutoff goes back with the query blocks. A total of at least the cutoff has an entry of at
   least ``cutoff / lists`` in some list, so each node sends every such entry. Together with what
   the missing entries can add at most, an entry gives an upper bound of its total; those whose
   bound is below the cutoff are left out.
3. The totals of the remaining (query, row) pairs are resolved exactly from the vectors.

Equal vectors are searched once, with their k + 1 smallest ids: no answer holds more of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamiz.runtime import materialize

#: Rows in a block of vectors and in a block of queries.
ROW_BLOCK, QUERY_BLOCK = 2048, 256
#: Above this sum of products, float64 sums of integers may round; int64 is used instead.
_EXACT = 2.0**53


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of integer rows, exact within 64 bits."""
    if len(q) and len(x) and np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * float(q.shape[1]) >= _EXACT:
        return q @ x.T
    return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)


def _pack(rows: DataFrame, key: str, size: int, block: str, ids: str) -> DataFrame:
    """(dim, block, ids, flat): rows of (id, dim, v) by blocks of about ``size``, in one array each."""
    each = rows.groupBy("dim").agg(F.count("*").alias("rows"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("rows") / size))
    return (
        rows.join(each, "dim").withColumn(block, F.pmod(F.xxhash64(key, F.lit(7)), blocks))
        .groupBy("dim", block).agg(F.collect_list(F.struct(F.col(key).alias("id"), "v")).alias("r"))
        .select("dim", block, F.col("r.id").alias(ids), F.flatten("r.v").alias("flat"))
    )


def _matrix(column: pa.Array, i: int, dim: int) -> np.ndarray:
    return column[i].values.to_numpy().reshape(-1, dim)


def _ranges(dim: int, lists: int) -> list[slice]:
    cuts = np.linspace(0, dim, min(lists, max(1, dim)) + 1).astype(int)
    return [slice(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]


def _phase_one(nodes: DataFrame, k: int, lists: int) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for i in range(batch.num_rows):
                dim = batch.column(0)[i].as_py()
                rows, queries = batch.column(1)[i].values.to_numpy(), batch.column(3)[i].values.to_numpy()
                x, q = _matrix(batch.column(2), i, dim), _matrix(batch.column(4), i, dim)
                total = _scores(q, x)
                best = np.zeros(total.shape, dtype=bool)
                for part in _ranges(dim, lists):
                    s = _scores(q[:, part], x[:, part])
                    top = np.argpartition(-s, min(k, s.shape[1]) - 1, axis=1)[:, :k]
                    np.put_along_axis(best, top, True, axis=1)
                a, b = np.nonzero(best)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(queries[a]), pa.array(rows[b]), pa.array(total[a, b])], names=["q", "x", "total"]
                )

    return nodes.select("dim", "xs", "xflat", "qs", "qflat").mapInArrow(run, "q long, x long, total long")


def _phase_two(nodes: DataFrame, lists: int) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for i in range(batch.num_rows):
                dim = batch.column(0)[i].as_py()
                rows, queries = batch.column(1)[i].values.to_numpy(), batch.column(3)[i].values.to_numpy()
                x, q = _matrix(batch.column(2), i, dim), _matrix(batch.column(4), i, dim)
                cut = batch.column(5)[i].values.to_numpy()[:, None]
                ranges = _ranges(dim, lists)
                m = len(ranges)
                bound = np.zeros((len(q), len(x)), dtype=np.float64)
                seen = np.zeros(bound.shape, dtype=bool)
                for part in ranges:
                    s = _scores(q[:, part], x[:, part])
                    sent = s >= -((-cut) // m)  # integers: at least the cutoff's share, rounded up
                    seen |= sent
                    bound += np.where(sent, s, cut / m)
                a, b = np.nonzero(seen & (bound * (1 + 1e-12 * np.sign(bound)) + 1 >= cut))
                yield pa.RecordBatch.from_arrays([pa.array(queries[a]), pa.array(rows[b])], names=["q", "x"])

    return nodes.select("dim", "xs", "xflat", "qs", "qflat", "cuts").mapInArrow(run, "q long, x long")


def search(
    vectors: DataFrame, is_query, k: int = 5, lists: int = 2, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows with the highest inner product for each query.

    ``is_query`` is a condition on the id column. A component x becomes floor(scale * x) as a
    64-bit integer; a product or sum beyond 64 bits raises an arithmetic error. A query is not its own candidate. Ties go to
    the smaller id. Queries with fewer candidates give fewer rows; candidates have the same number
    of components as the query.

    Reads only the two named columns, so extra columns cannot clash. Rows whose vector is null,
    empty or holds null or non-finite components, or whose id is null, take no part. Of rows with
    one id and one vector only one counts; an id with different vectors is searched once for each,
    and a row with the query's id is never its answer. An empty table gives an empty result.
    """
    clean = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("e")).where(
        "id is not null and size(e) > 0 and forall(e, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
    )
    whole = clean.select("id", F.transform("e", lambda x: F.floor(x * F.lit(scale))).alias("v"))
    # equal vectors once: smallest ids only, as ties go to them and a query leaves out at most itself
    least = Window.partitionBy("v").orderBy("id")
    same = (
        whole.distinct().withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    )
    rows = materialize(same.select(F.monotonically_increasing_id().alias("x"), F.size("v").alias("dim"), "v", "ids"), "vectors")
    asked = whole.where(is_query(F.col("id"))).distinct()
    asked = materialize(asked.select(F.monotonically_increasing_id().alias("q"), F.size("v").alias("dim"), "id", "v"), "queries")

    xs = materialize(_pack(rows, "x", ROW_BLOCK, "xb", "xs").withColumnRenamed("flat", "xflat"), "blocks")
    qs = materialize(_pack(asked, "q", QUERY_BLOCK, "qb", "qs").withColumnRenamed("flat", "qflat"), "blocks")
    query_blocks = qs.groupBy("dim").agg(F.collect_list("qb").alias("qbs"))
    laid = xs.join(query_blocks, "dim").select("dim", "xb", "xs", "xflat", F.explode("qbs").alias("qb"))

    # 1. one more than k, as the query itself can be among the best
    first = _phase_one(laid.join(qs, ["dim", "qb"]), k + 1, lists)
    held = rows.select("x", "ids")
    best = first.join(held, "x").join(asked.select("q", F.col("id").alias("own")), "q").select(
        "q", "x", "total", F.size(F.array_except("ids", F.array("own"))).alias("copies")
    )
    order = Window.partitionBy("q").orderBy(F.desc("total"), "x")
    ranked = best.where("copies > 0").withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)
    so_far = Window.partitionBy("q").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        ranked.withColumn("have", F.sum("copies").over(so_far)).where(F.col("have") >= k)
        .groupBy("q").agg(F.max("total").alias("cut"))
    )
    # fewer than k candidates in all: everything is sufficient
    cut = asked.select("q").join(cut, "q", "left").select("q", F.coalesce("cut", F.lit(-(2**62))).alias("cut"))
    cuts = (
        qs.select("dim", "qb", F.posexplode("qs").alias("p", "q")).join(cut, "q")
        .groupBy("dim", "qb").agg(F.array_sort(F.collect_list(F.struct("p", "cut"))).alias("c"))
        .select("dim", "qb", F.col("c.cut").alias("cuts"))
    )

    # 2. sufficient entries
    enough = _phase_two(laid.join(qs.join(cuts, ["dim", "qb"]), ["dim", "qb"]), lists)

    # 3. exact totals
    dot = F.aggregate(F.zip_with("qv", "v", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, p: s + p)
    exact = (
        enough.join(asked.select("q", F.col("id").alias("query_id"), F.col("v").alias("qv")), "q")
        .join(rows.select("x", "v", "ids"), "x")
        .select("q", "query_id", "ids", dot.alias("score"))
        .select("q", "query_id", "score", F.explode(F.array_except("ids", F.array("query_id"))).alias("vec_id"))
    )
    answer = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return exact.withColumn("rank", F.row_number().over(answer)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
