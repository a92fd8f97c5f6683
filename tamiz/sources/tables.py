"""Text CSV in, tables and reports out, and row numbers across files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.text import strip
from ..runtime import materialize

CHUNK = 100_000


def read_text_csv(
    spark: SparkSession, path: str, columns: list[str], multi_line: bool,
    blank_as_null: bool = False, stripped: bool = False,
) -> DataFrame:
    """Columns of a headed UTF-8 CSV, all as text, found by their names in the header.

    Other columns are left out and the order in the file does not matter; a
    missing column raises ValueError, and so does reading files whose headers
    differ. Empty cells are ``''`` unless ``blank_as_null``. Quotes are
    doubled, not escaped by a backslash. ``multi_line`` allows line breaks
    inside cells but reads each file as one split; without it large files are
    split.
    """
    df = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    cells = [F.col(f"`{c}`") for c in columns]
    if blank_as_null:
        return df.select(*[F.nullif(v, F.lit("")).alias(c) for c, v in zip(columns, cells)])
    filled = [F.coalesce(v, F.lit("")) for v in cells]
    return df.select(*[(strip(v) if stripped else v).alias(c) for c, v in zip(columns, filled)])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headed CSV, quotes doubled; the header is written even without rows."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_by_source(df: DataFrame, path: str, source: str = "source", mode: str = "overwrite") -> None:
    """Parquet partitioned by source; ``overwrite`` replaces only the sources present in ``df``.

    The rebalance hint brings rows of a source together without one task per
    source: adaptive execution splits a large source and merges small ones, so
    files come out in a useful size.
    """
    (
        df.hint("rebalance", F.col(source))
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(source)
        .parquet(path)
    )


def consolidate(parts: list[DataFrame]) -> DataFrame:
    """All source tables as one; columns are matched by name."""
    return reduce(DataFrame.unionByName, parts)


def number_rows(
    df: DataFrame, source: str, pos: str, into: str = "row_number", start: int = 2, chunk: int = CHUNK
) -> DataFrame:
    """Consecutive numbers in (source, pos) order; ``pos`` is a unique integer per source.

    Rows are ranked inside ranges of ``chunk`` positions and written once; the input
    is read once. The ranges, fewer than the rows by the factor ``chunk``, are sorted into
    partitions by (source, range) and summed inside each, and the driver adds the
    sums of the partitions before it: one number for each.
    """
    inside = F.row_number().over(Window.partitionBy(source, "_chunk").orderBy(pos))
    ranked = materialize(df.withColumn("_chunk", F.floor(F.col(pos) / chunk)).withColumn("_rank", inside), "ranked")
    sizes = ranked.groupBy(source, "_chunk").agg(F.count("*").alias("_n")).repartitionByRange(source, "_chunk")
    sizes = materialize(sizes.withColumn("_part", F.spark_partition_id()), "sizes")
    earlier, so_far = {}, 0
    for part, n in sorted(map(tuple, sizes.groupBy("_part").agg(F.sum("_n")).collect())):
        earlier[part], so_far = so_far, so_far + n
    before = Window.partitionBy("_part").orderBy(source, "_chunk").rowsBetween(Window.unboundedPreceding, -1)
    of_part = F.try_element_at(F.create_map(*[F.lit(int(x)) for pair in (earlier or {0: 0}).items() for x in pair]), F.col("_part"))
    offsets = sizes.select(
        F.col(source).alias("_s"), F.col("_chunk").alias("_c"),
        (of_part + F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_before"),
    )
    joined = ranked.join(
        offsets, F.col(source).eqNullSafe(F.col("_s")) & (F.col("_chunk") == F.col("_c"))
    )
    number = (F.col("_before") + F.col("_rank") + (start - 1)).cast("long")
    return joined.withColumn(into, number).drop("_chunk", "_rank", "_s", "_c", "_before")
