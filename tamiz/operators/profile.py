"""Column profiles, missing values, frequencies and closed-domain checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.codes import CODE_PATTERN
from ..functions.text import is_blank, is_diagnosis_placeholder, normalize_text, normalize_upper


def ordinal(column: Column, names: list[str]) -> Column:
    """1-based position of a name in ``names``."""
    return F.array_position(F.array(*[F.lit(n) for n in names]), column)


def _value_counts_long(df: DataFrame, cols: list[str], row_col: str, norm) -> DataFrame:
    """(column, value, cnt, first_row) of all columns with one shuffle."""
    long = df.select(F.col(row_col).alias("_row"), *[norm(F.col(c)).alias(c) for c in cols])
    long = long.unpivot(["_row"], cols, "column", "value")
    return long.groupBy("column", "value").agg(
        F.count("*").alias("cnt"), F.min("_row").alias("first_row")
    )


def _top_values(counts: DataFrame) -> DataFrame:
    """Per column: distinct and total non-empty values, top value (ties: first seen)."""
    filled = F.col("value") != ""
    used = F.when(filled, F.col("cnt")).otherwise(F.lit(0))
    return counts.groupBy("column").agg(
        F.sum(filled.cast("long")).alias("unique_values"),
        F.sum(used).alias("filled_values"),
        F.max_by("value", F.struct(filled, "cnt", -F.col("first_row"))).alias("top_value"),
        F.max(used).alias("top_count"),
    )


def profile_columns(df: DataFrame, cols: list[str], row_col: str, type_of=None) -> DataFrame:
    """Logical type, distinct and filled counts and most frequent value per column.

    ``type_of`` maps a column-name Column to its logical type.
    """
    top = _top_values(_value_counts_long(df, cols, row_col, normalize_text))
    kind = type_of(F.col("column")) if type_of else F.lit("texto")
    return top.select(
        "column",
        kind.alias("tipo_dato_detectado"),
        F.col("unique_values").alias("valores_unicos"),
        F.col("filled_values").alias("valores_no_vacios"),
        F.col("top_value").alias("valor_mas_frecuente"),
        F.col("top_count").alias("frecuencia_top"),
    )


def category_summary(df: DataFrame, cols: list[str], row_col: str) -> DataFrame:
    """Distinct values, top value and its count on upper-cased text."""
    top = _top_values(_value_counts_long(df, cols, row_col, normalize_upper))
    return top.select("column", "unique_values", "top_value", "top_count")


def missing_report(df: DataFrame, cols: list[str], missing=is_blank) -> DataFrame:
    """Missing count, percent and filled count per column, most missing first."""
    one_row = df.agg(
        F.count("*").alias("_n"),
        *[F.count(F.when(F.coalesce(missing(F.col(c)), F.lit(True)), 1)).alias(c) for c in cols],
    )
    return (
        one_row.unpivot(["_n"], cols, "column", "missing_count")
        .select(
            "column",
            "missing_count",
            F.coalesce(
                F.round(F.try_divide(100 * F.col("missing_count"), F.col("_n")), 2), F.lit(0.0)
            ).alias("missing_pct"),
            (F.col("_n") - F.col("missing_count")).alias("non_missing_count"),
        )
        .orderBy(F.desc("missing_count"), "column")
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(normalize_text(F.col(col)).alias("value")).agg(F.count("*").alias("n"))


def repeated_ids(df: DataFrame, key: str) -> DataFrame:
    """Non-blank identifiers that occur more than once, in order."""
    blank = is_blank(F.col(key)) if dict(df.dtypes)[key] == "string" else F.col(key).isNull()
    return (
        df.filter(~blank)
        .groupBy(key)
        .agg(F.count("*").alias("repeticiones"))
        .filter("repeticiones > 1")
        .orderBy(key)
    )


def count_where(df: DataFrame, condition: Column, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.when(condition, 1)).alias(name))


def invalid_rows(
    df: DataFrame, col: str, context: list[str], pattern: str = CODE_PATTERN
) -> DataFrame:
    """Rows whose ``col`` breaks the pattern, with context columns."""
    return df.filter(~F.col(col).rlike(pattern)).select(*context)


def placeholder_rows(df: DataFrame, cols: list[str], row_col: str) -> DataFrame:
    """One row per (row, column) whose value is a diagnosis-stage placeholder."""
    return (
        df.select(row_col, *cols)
        .unpivot([row_col], cols, "column", "value")
        .filter(is_diagnosis_placeholder(F.col("value")))
    )


def placeholder_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    one_row = df.agg(
        *[F.count(F.when(is_diagnosis_placeholder(F.col(c)), 1)).alias(c) for c in cols]
    )
    return one_row.unpivot([], cols, "column", "placeholder_rows")


def duplicate_summary(
    df: DataFrame, cols: list[str], key: str, pattern: str = CODE_PATTERN
) -> DataFrame:
    """Full-row repeats, surplus occurrences of the key, keys that break the pattern.

    Counting per full row first lets the two key metrics reuse the groups.
    """
    rows = df.groupBy(*cols).agg(F.count("*").alias("_n"))
    per_key = rows.groupBy(key).agg(
        F.sum("_n").alias("_n"), F.sum(F.col("_n") - 1).alias("_repeats")
    )
    blank = is_blank(F.col(key).cast("string"))
    names = ["duplicados exactos", f"{key} repetido", f"{key} invalido"]
    one_row = per_key.agg(
        F.coalesce(F.sum("_repeats"), F.lit(0)).alias(names[0]),
        F.coalesce(F.sum(F.when(~blank, F.col("_n") - 1)), F.lit(0)).alias(names[1]),
        F.coalesce(
            F.sum(F.when(~F.col(key).cast("string").rlike(pattern), F.col("_n"))), F.lit(0)
        ).alias(names[2]),
    )
    return one_row.unpivot([], names, "tipo", "cantidad")


def unexpected_values(df: DataFrame, col: str, domain: DataFrame) -> DataFrame:
    """Distinct upper-cased non-blank values of ``col`` that ``domain`` (column value) lacks."""
    observed = df.select(normalize_upper(F.col(col)).alias("value")).filter("value <> ''")
    return observed.distinct().join(domain.select("value"), "value", "left_anti").orderBy("value")


def value_list(df: DataFrame, values: list[str]) -> DataFrame:
    return df.sparkSession.createDataFrame([(v,) for v in values], "value string")


def catalog_validation(
    df: DataFrame,
    domains: dict[str, list[str]],
    catalogs: dict[str, DataFrame],
    catalog_label: str = " departamentos locales",
) -> DataFrame:
    """Expected and unexpected values per column, against lists and catalogue tables.

    One row for each unexpected value of a column, with their number; a column
    without any has one row with ``''`` and 0.
    """
    spark = df.sparkSession
    names = list(domains) + list(catalogs)
    checks = spark.createDataFrame(
        [(c, ", ".join(sorted(v))) for c, v in domains.items()], "column string, expected string"
    )
    known = spark.createDataFrame(
        [(c, v) for c, vals in domains.items() for v in vals], "column string, value string"
    )
    for col, table in catalogs.items():
        members = table.select(F.lit(col).alias("column"), "value").distinct()
        known = known.unionByName(members)
        size = members.agg(F.count("*").cast("string").alias("n"))
        checks = checks.unionByName(
            size.select(
                F.lit(col).alias("column"), F.concat("n", F.lit(catalog_label)).alias("expected")
            )
        )
    observed = (
        df.select(*[normalize_upper(F.col(c)).alias(c) for c in names])
        .unpivot([], names, "column", "value")
        .filter("value <> ''")
        .distinct()
        .join(known, ["column", "value"], "left_anti")
    )
    counts = observed.groupBy("column").agg(F.count("*").alias("unexpected_count"))
    return (
        checks.join(counts, "column", "left")
        .join(observed, "column", "left")
        .select(
            "column",
            F.col("expected").alias("expected_values"),
            F.coalesce("value", F.lit("")).alias("unexpected_value"),
            F.coalesce("unexpected_count", F.lit(0)).alias("unexpected_count"),
        )
        .orderBy(ordinal(F.col("column"), names), "unexpected_value")
    )


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("filas")).withColumn("columnas", F.lit(len(df.columns)))


def preview(df: DataFrame, row_col: str, n: int = 5) -> DataFrame:
    """First ``n`` rows in row order; each row says how many rows follow the preview."""
    total = df.agg(F.count("*")).scalar()
    head = df.orderBy(row_col).limit(n)
    return head.withColumn("filas_adicionales", F.greatest(total - n, F.lit(0).cast("long")))


def stack_reports(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
