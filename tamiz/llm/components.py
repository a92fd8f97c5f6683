"""Connected components as Spark jobs, by alternating large-star and small-star steps; small join sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.runtime import materialize


#: A side of at most this many rows of numbers is broadcast, a larger one joined by a shuffle.
BROADCAST_ROWS = 2_000_000


def small(table: DataFrame) -> DataFrame:
    """The table, marked for broadcast when it is counted to be within BROADCAST_ROWS."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _step(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a, b) with a > b; a node's minimum is combined before the shuffle."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = edges
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    linked = both.join(least, "a")
    moved = linked.where("b > a") if large else linked.where("b <> m")
    pairs = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        pairs = pairs.unionByName(least.select("a", F.col("m").alias("b")))
    return pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), root being the smallest node reachable.

    Each round is one job over tables in the shared checkpoint folder. Nodes, links and
    roots stay in Spark; the driver sees a row count and a checksum per round. Self links
    and nulls are ignored; no links give an empty table.
    """
    edges = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = _state(edges)
    while before[0]:
        edges = materialize(_step(_step(edges, True), False), "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
