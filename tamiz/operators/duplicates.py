"""Exact duplicates: counts and row flags without a window over the fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def row_digest(df: DataFrame, cols: list[str]) -> Column:
    """32 bytes that stand for the values of ``cols``: equal rows have equal digests.

    Each value goes in with its length or as a null mark, so different rows
    differ before hashing. Two different rows would need a SHA-256 collision to
    count as equal. Whole texts are hashed where they are read; shuffles see
    the digest only.
    """
    parts = []
    for c, kind in ((c, df.schema[c].dataType.typeName()) for c in cols):
        value = F.col(c)
        if kind in ("float", "double"):
            value = value + F.lit(0.0).cast(kind)  # -0.0 equals 0.0
        text = F.to_json(F.struct(value.alias("v"))) if kind in ("array", "map", "struct", "variant") else value.cast("string")
        parts.append(F.when(value.isNull(), F.lit("n")).otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text)))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def duplicate_groups(df: DataFrame, cols: list[str], row_col: str) -> DataFrame:
    """Groups of equal rows (NULL equals NULL) with more than one member, by digest."""
    return (
        df.select(row_digest(df, cols).alias("_digest"), F.col(row_col).alias("_row"))
        .groupBy("_digest")
        .agg(F.count("*").alias("_members"), F.min("_row").alias("_first"))
        .filter("_members > 1")
    )


def count_duplicates(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: members of duplicate groups, and repeats after the first occurrence."""
    groups = df.select(row_digest(df, cols).alias("_digest")).groupBy("_digest").agg(F.count("*").alias("_n"))
    return groups.agg(
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("members"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("repeats"),
    )


def flag_duplicates(df: DataFrame, cols: list[str], row_col: str) -> DataFrame:
    """Add ``duplicated`` (any member of a group) and ``seen_before`` (not the first).

    The groups come from a partially aggregated groupBy and are joined back, so
    a group that holds a large part of the table is never sorted in one task;
    adaptive execution splits its side of the join.
    """
    groups = duplicate_groups(df, cols, row_col).select(F.col("_digest").alias("_group"), "_first")
    joined = df.withColumn("_digest", row_digest(df, cols)).join(groups, F.col("_digest") == F.col("_group"), "left")
    return joined.select(
        *df.columns,
        F.col("_first").isNotNull().alias("duplicated"),
        (F.col("_first").isNotNull() & (F.col(row_col) > F.col("_first"))).alias("seen_before"),
    )
