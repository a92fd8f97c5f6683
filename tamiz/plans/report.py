"""Quality before and after cleaning, and the duplicate review."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions.text import clean_spaces, is_placeholder
from ..operators.duplicates import row_digest
from ..operators.fuzzy import (
    DEFAULT_THRESHOLD, count_similar, decision_summary, fuzzy_pairs, name_forms, not_identical,
    similar_forms, with_decisions,
)
from ..operators.places import PlaceRules, standardize_places
from ..runtime import materialize
from .cleaning import RAW, affected_rows, clean_aligned, counter_aggs, log_counters, still_changed
from .rules import COLUMNS, DERIVED, SIMPLE_CATEGORIES

# Metric names in report order.
METRICS = [
    "Registros",
    "Variables",
    "Valores faltantes",
    "% faltantes",
    "Variables con NA",
    "Duplicados exactos (fila completa)",
    "Posibles duplicados parciales (nombre similar, no identico)",
    "Establecimientos unicos (ESTABLECIMIENTO)",
    "Variables con formato inconsistente",
    "Variables con tipo incorrecto",
    "Categorias inconsistentes (variantes de escritura)",
    "Errores corregidos (registros modificados)",
]


def _sum(cols: list[Column]) -> Column:
    total = F.lit(0).cast("long")
    for c in cols:
        total = total + c
    return total


def _rows(one_row: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Turn columns of a one-row frame into (metric, value) rows."""
    parts = [
        F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value")) for m, v in values.items()
    ]
    return one_row.select(F.inline(F.array(*parts)))


def align_metrics(before: DataFrame, after: DataFrame, order: list[str] = METRICS) -> DataFrame:
    """(ord, metric, before, after): every "before" metric with its "after" value, if any."""
    b = before.select("metric", F.col("value").alias("before"))
    a = after.select("metric", F.col("value").alias("after"))
    position = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("metric"))
    return (
        b.join(a, "metric", "left")
        .select(position.cast("int").alias("ord"), "metric", "before", "after")
        .orderBy("ord")
    )


def measured(aligned: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """The cleaned table, written once, and what was counted on the way.

    ``rows``; ``raw_<column>`` and ``clean_<column>``, missing cells; ``again_<column>``, finished
    cells that cleaning would still change; and the counters of the log. The counts are taken by
    the tasks that write the table, without another scan.
    """
    seen = Observation()

    def count(name: str, condition: Column) -> Column:
        return F.count(F.when(condition, 1)).alias(name)

    counted = aligned.observe(
        seen, F.count("*").alias("rows"), *counter_aggs(),
        *[count(f"raw_{c}", is_placeholder(F.col(f"{RAW}.{c}"))) for c in COLUMNS],
        *[count(f"clean_{c}", F.col(c).isNull()) for c in COLUMNS],
        *[count(f"again_{c}", changed) for c, changed in still_changed().items()],
    )
    written = materialize(counted, "clean")
    return written, seen.get


def _shape(counts: dict[str, int], prefix: str, variables: int) -> dict[str, float]:
    """Rows, columns, missing cells, percent and columns with missing values."""
    missing = [counts[f"{prefix}_{c}"] for c in COLUMNS]
    cells = counts["rows"] * len(COLUMNS)
    percent = float((Decimal(100 * sum(missing)) / cells).quantize(Decimal("0.01"), ROUND_HALF_UP)) if cells else 0.0
    values = [counts["rows"], variables, sum(missing), percent, sum(n > 0 for n in missing)]
    return dict(zip(METRICS[:5], values))


def _known(spark: SparkSession, values: dict[str, float]) -> DataFrame:
    return spark.createDataFrame([(m, float(v)) for m, v in values.items()], "metric string, value double")


def _similar_count(df: DataFrame, row_col: str, name: str, block: list[str], threshold: int) -> DataFrame:
    forms = name_forms(df, name, block, row_col)
    pairs = count_similar(not_identical(similar_forms(forms, block, threshold)))
    return _rows(pairs, {METRICS[6]: F.col("pares")})


def _group_metrics(df: DataFrame, dim: DataFrame, rules: PlaceRules, name: str) -> DataFrame:
    """Exact duplicates, distinct names and spelling variants of categories, from one scan.

    Every row gives its digest, its name and its categories as (kind, a, b); each of them is
    counted once, combined before the shuffle.
    """
    none = F.lit(None).cast("string")

    def entry(kind: str, a: Column, b: Column = none) -> Column:
        return F.struct(F.lit(kind).alias("kind"), a.alias("a"), b.alias("b"))

    dep, mun = clean_spaces(F.col(rules.department)), clean_spaces(F.col(rules.municipality))
    entries = [
        entry("row", F.hex(row_digest(df, COLUMNS))), entry("name", F.col(name)), entry("department", dep), entry("place", dep, mun),
        *[entry(c, clean_spaces(F.col(c))) for c in SIMPLE_CATEGORIES],
    ]
    groups = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*").groupBy("kind", "a", "b").agg(F.count("*").alias("n"))
    of_place = F.col("kind").isin("department", "place")
    placed = standardize_places(
        groups.withColumn(rules.department, F.when(of_place, F.col("a"))).withColumn(rules.municipality, F.when(of_place, F.col("b"))),
        dim, rules,
    )
    kind, a = F.col("kind"), F.col("a")
    variant = (
        F.when(kind == "department", F.col(rules.department) != F.upper(a))
        .when(kind == "place", F.col(rules.municipality) != F.upper("b"))
        .when(kind.isin(SIMPLE_CATEGORIES), a != F.upper(a))
    )
    one_row = placed.agg(
        F.sum(F.when((kind == "row") & (F.col("n") > 1), F.col("n"))).alias("members"),
        F.count(F.when(kind == "name", a)).alias("names"),
        F.count(F.when(variant, 1)).alias("variants"),
    )
    return _rows(one_row, {
        METRICS[5]: F.coalesce("members", F.lit(0)), METRICS[7]: F.col("names"), METRICS[10]: F.col("variants"),
    })


def wrong_types(df: DataFrame) -> int:
    """Original columns that are not text."""
    kinds = dict(df.dtypes)
    return sum(kinds[c] != "string" for c in COLUMNS)


def report_of(
    aligned: DataFrame, counts: dict[str, int], dim: DataFrame, row_col: str, rules: PlaceRules = PlaceRules(),
    name: str = "ESTABLECIMIENTO", threshold: int = DEFAULT_THRESHOLD,
) -> DataFrame:
    """The before/after report of a table from :func:`measured`.

    Besides the search for similar names, raw and clean rows are scanned once each.
    """
    spark, block = aligned.sparkSession, [rules.department, rules.municipality]
    raw = aligned.select(row_col, f"{RAW}.*")
    cleaned = aligned.select(row_col, *COLUMNS, *DERIVED)
    one_row = spark.range(1).select(*[F.lit(counts[c]).cast("bigint").alias(c) for c in log_counters()])
    affected = list(affected_rows().values())
    again = [counts[f"again_{c}"] for c in COLUMNS]
    before = (
        _known(spark, {**_shape(counts, "raw", len(COLUMNS)), METRICS[9]: wrong_types(raw)})
        .unionByName(_rows(one_row, {METRICS[8]: _sum([(c > 0).cast("long") for c in affected]), METRICS[11]: _sum(affected)}))
        .unionByName(_group_metrics(raw, dim, rules, name))
        .unionByName(_similar_count(raw, row_col, name, block, threshold))
    )
    after = (
        _known(spark, {
            **_shape(counts, "clean", len(COLUMNS) + len(DERIVED)), METRICS[9]: wrong_types(cleaned),
            METRICS[8]: sum(n > 0 for n in again), METRICS[11]: sum(again),
        })
        .unionByName(_group_metrics(cleaned, dim, rules, name))
        .unionByName(_similar_count(cleaned, row_col, name, block, threshold))
    )
    return align_metrics(before, after)


def quality_report(
    df: DataFrame,
    dim: DataFrame,
    row_col: str,
    rules: PlaceRules = PlaceRules(),
    name: str = "ESTABLECIMIENTO",
    threshold: int = DEFAULT_THRESHOLD,
) -> DataFrame:
    """The before/after report of 12 metrics.

    The cleaned table, raw row beside it, is written once and feeds every
    metric. What is "corrected" in the finished table is measured like the rest: cells that
    cleaning would change again.
    """
    aligned, counts = measured(clean_aligned(df, dim, rules, [row_col], row_col))
    return report_of(aligned, counts, dim, row_col, rules, name, threshold)


def duplicate_review(
    df: DataFrame, row_col: str, threshold: int = DEFAULT_THRESHOLD
) -> tuple[DataFrame, DataFrame]:
    """(similar pairs with their decision, number of pairs per decision)."""
    cols = ["CODIGO", "DEPARTAMENTO", "MUNICIPIO", "ESTABLECIMIENTO", "DIRECCION", "TELEFONO", "STATUS"]
    rows = materialize(df.select(row_col, *cols), "review")
    pairs = with_decisions(fuzzy_pairs(rows, row_col, threshold=threshold))
    return pairs, decision_summary(rows, row_col, threshold=threshold)
