"""Names that occur several times in one block, with what differs between the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

# Report columns and the columns they count.
DETAILS = {
    "direcciones_distintas": "DIRECCION",
    "status_distintos": "STATUS",
    "jornadas_distintas": "JORNADA",
    "planes_distintos": "PLAN",
}
CHUNK = 10_000  # codes per part of a list; bounds every collected list


def _members(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def repeated_groups(
    df: DataFrame, name: str = "ESTABLECIMIENTO", block=("DEPARTAMENTO", "MUNICIPIO"),
    details: dict[str, str] = DETAILS,
) -> DataFrame:
    """Group sizes (2 or more) and distinct detail values; NULL keys are left out."""
    keys = [*block, name]
    return (
        _members(df, keys)
        .groupBy(*keys)
        .agg(
            F.count("*").alias("registros"),
            *[F.countDistinct(c).alias(out) for out, c in details.items()],
        )
        .filter("registros >= 2")
    )


def repeated_codes(
    df: DataFrame, row_col: str, name: str = "ESTABLECIMIENTO",
    block=("DEPARTAMENTO", "MUNICIPIO"), code: str = "CODIGO",
) -> DataFrame:
    """Codes of each group of two or more rows in row order, as consecutive parts.

    A part has up to ``CHUNK`` codes, so a group of any size is listed in full
    while no single list can outgrow it. The parts in order, joined by
    ``'; '``, are the whole list. Rows are ranked inside ranges of row
    positions and the rows of earlier ranges are added, so that no task orders
    a whole group.
    """
    keys = [*block, name]
    rows = _members(df, keys).select(
        *keys, F.col(row_col).alias("_r"), F.col(code).alias("_c"), F.floor(F.col(row_col) / CHUNK).alias("_range")
    )
    sizes = rows.groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
    group = Window.partitionBy(*keys)
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        *keys, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(group).alias("_all")
    ).filter("_all >= 2")
    rank = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy("_r"))
    placed = rows.withColumn("_rank", rank).join(sizes, [*keys, "_range"])
    return (
        placed.withColumn("part", F.floor((F.col("_before") + F.col("_rank") - 1) / CHUNK))
        .groupBy(*keys, "part")
        .agg(
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("_r", "_c"))), lambda s: s["_c"]), "; "
            ).alias("codigos")
        )
    )


def repeated_names(
    df: DataFrame, row_col: str, name: str = "ESTABLECIMIENTO",
    block=("DEPARTAMENTO", "MUNICIPIO"), code: str = "CODIGO",
    details: dict[str, str] = DETAILS,
) -> DataFrame:
    """Repeated names, most distinct addresses first, with their codes joined in row order.

    One row for each part of a group's list, see :func:`repeated_codes`; up to
    ``CHUNK`` rows that is one row, part 0.
    """
    keys = [*block, name]
    first_detail = next(iter(details))
    return (
        repeated_groups(df, name, block, details)
        .join(repeated_codes(df, row_col, name, block, code), keys)
        .select(
            F.col(block[0]).alias("departamento"),
            F.col(block[1]).alias("municipio"),
            F.col(name).alias("establecimiento"),
            "registros", *details, F.col("part").alias("parte"), "codigos",
        )
        .orderBy(F.desc(first_detail), F.desc("registros"), "departamento", "municipio", "establecimiento", "parte")
    )
