"""Consistency between columns, and spelling variants of categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import clean_spaces
from .places import PlaceRules, standardize_places


def dependency_check(
    df: DataFrame,
    groups: dict[str, tuple[list[str], list[str]]],
    a: str = "DEPARTAMENTO",
    b: str = "DEPARTAMENTAL",
) -> DataFrame:
    """For each group: all members of A have B in its set, and no other row has.

    ``groups`` maps a label to (values of A, allowed values of B). One row per
    group plus the row ``consistente`` for all of them; one aggregation in all.
    """
    aggs = []
    for label, (members, allowed) in groups.items():
        in_a, in_b = F.col(a).isin(members), F.col(b).isin(allowed)
        in_a = F.coalesce(in_a, F.lit(False))
        in_b = F.coalesce(in_b, F.lit(False))
        aggs.append(F.coalesce(F.bool_and(F.when(in_a, in_b)), F.lit(True)).alias(f"{label}__in"))
        aggs.append(F.coalesce(F.bool_or(F.when(~in_a, in_b)), F.lit(False)).alias(f"{label}__out"))
    one_row = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(label).alias("grupo"),
            F.col(f"{label}__in").alias("miembros_en_conjunto"),
            F.col(f"{label}__out").alias("otros_en_conjunto"),
        )
        for label in groups
    ]
    whole = F.struct(
        F.lit("consistente").alias("grupo"),
        F.forall(F.array(*[F.col(f"{g}__in") for g in groups]), lambda x: x).alias(
            "miembros_en_conjunto"
        ),
        F.exists(F.array(*[F.col(f"{g}__out") for g in groups]), lambda x: x).alias(
            "otros_en_conjunto"
        ),
    )
    return one_row.select(F.inline(F.array(*rows, whole))).withColumn(
        "consistente", F.col("miembros_en_conjunto") & ~F.col("otros_en_conjunto")
    )


def inconsistent_categories(
    df: DataFrame, dim: DataFrame, simple: list[str], rules: PlaceRules = PlaceRules()
) -> DataFrame:
    """Distinct spellings that cleaning maps to another form, per grain.

    Grains: departments, (department, municipality) pairs, simple categories.
    """
    dep, mun = rules.department, rules.municipality
    pairs = df.select(
        clean_spaces(F.col(dep)).alias("_d"), clean_spaces(F.col(mun)).alias("_m")
    ).distinct()
    canon = standardize_places(
        pairs.withColumn(dep, F.col("_d")).withColumn(mun, F.col("_m")), dim, rules
    )
    departments = (
        canon.select("_d", F.col(dep).alias("_c")).distinct()
        .agg(F.count(F.when(F.col("_c") != F.upper("_d"), 1)).alias("variantes"))
        .select(F.lit(dep).alias("columna"), "variantes")
    )
    places = canon.agg(
        F.count(F.when(F.col(mun) != F.upper("_m"), 1)).alias("variantes")
    ).select(F.lit(mun).alias("columna"), "variantes")
    values = (
        df.select(*[clean_spaces(F.col(c)).alias(c) for c in simple])
        .unpivot([], simple, "columna", "_v")
        .distinct()
        .groupBy("columna")
        .agg(F.count(F.when(F.col("_v") != F.upper("_v"), 1)).alias("variantes"))
    )
    return departments.unionByName(places).unionByName(values)
