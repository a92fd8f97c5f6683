"""Data-quality expectations.

Each returns (rule, column, failures, sample); a rule holds when it has no
failures. ``sample`` holds the smallest failing values, each once, at most
``SAMPLE`` of them. Row-level rules of one table share a single scan, see
:func:`check`, and what fails is written once, counted by value; the sample is
cut in the tasks, so neither count nor sample gathers the values of a rule.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.codes import CODE_PATTERN
from ..functions.text import strip
from ..runtime import materialize
from .duplicates import count_duplicates

SAMPLE = 10
RESULT = "rule string, column string, failures bigint, sample array<string>"
# Fixed value: one usable number of a multi-valued phone cell.
SINGLE_PHONE = r"^\p{Nd}{7,8}$"


@dataclass
class RowRule:
    """A rule every row must meet; ``failed`` marks the rows that do not."""

    rule: str
    column: str
    failed: Column
    value: Column


def _named(df: DataFrame, rows: list[tuple[str, str]]) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, "rule string, column string")


def _result(values: DataFrame, named: DataFrame) -> DataFrame:
    """The result of the rules ``named`` (rule, column) from the failing ``values`` (rule, column, value, n)."""
    key = ["rule", "column"]
    values = materialize(values.select(*key, F.col("value").cast("string").alias("value"), F.col("n").cast("bigint").alias("n")), "failing")
    counted = values.groupBy(*key).agg(F.sum("n").alias("failures"))
    place = F.row_number().over(Window.partitionBy(*key).orderBy("value"))
    first = values.filter("value IS NOT NULL").withColumn("place", place).filter(F.col("place") <= SAMPLE)
    sample = first.groupBy(*key).agg(F.sort_array(F.collect_list("value")).alias("sample"))
    return named.join(counted, key, "left").join(sample, key, "left").select(
        *key, F.coalesce("failures", F.lit(0).cast("bigint")).alias("failures"),
        F.coalesce("sample", F.array().cast("array<string>")).alias("sample"),
    )


def _one(values: DataFrame, rule: str, column: str) -> DataFrame:
    """The result of one rule from its failing ``values`` (value, n)."""
    return _result(values.select(F.lit(rule).alias("rule"), F.lit(column).alias("column"), "value", "n"), _named(values, [(rule, column)]))


def check(df: DataFrame, rules: list[RowRule]) -> DataFrame:
    """Evaluate all row rules in one pass over ``df``; different rules of one column may share a name."""
    failed = [
        F.when(r.failed, F.struct(F.lit(r.rule).alias("rule"), F.lit(r.column).alias("column"), r.value.cast("string").alias("value")))
        for r in rules
    ]
    cells = df.select(F.explode(F.array_compact(F.array(*failed))).alias("f")).select("f.*")
    values = cells.groupBy("rule", "column", "value").agg(F.count("*").alias("n"))
    return _result(values, _named(df, list(dict.fromkeys((r.rule, r.column) for r in rules))))


def no_edge_spaces(cols: list[str]) -> list[RowRule]:
    return [RowRule("edge_spaces", c, F.col(c) != strip(F.col(c)), F.col(c)) for c in cols]


def in_domain(domains: dict[str, list[str]]) -> list[RowRule]:
    return [RowRule("domain", c, ~F.col(c).isin(v), F.col(c)) for c, v in domains.items()]


def has_pattern(col: str, pattern: str = CODE_PATTERN) -> RowRule:
    return RowRule("pattern", col, ~F.col(col).rlike(pattern), F.col(col))


def not_null(col: str) -> RowRule:
    return RowRule("not_null", col, F.col(col).isNull(), F.lit(None))


def flag_coherent(col: str, flag: str) -> RowRule:
    """The flag is never true where the value is missing."""
    return RowRule("flag_coherence", flag, F.col(col).isNull() & F.col(flag), F.col(flag))


def integer_text(col: str) -> RowRule:
    bad = F.col(col).isNotNull() & F.col(col).cast("string").try_cast("int").isNull()
    return RowRule("integer", col, bad, F.col(col))


def expect_not_empty(df: DataFrame) -> DataFrame:
    counted = df.agg(F.count("*").alias("rows")).select(F.lit(None).cast("string").alias("value"), (F.col("rows") == 0).cast("bigint").alias("n"))
    return _one(counted, "not_empty", "*")


def expect_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """One row per required column; checked on the schema."""
    rows = [("column_present", c, 0 if c in df.columns else 1, []) for c in required]
    return df.sparkSession.createDataFrame(rows, RESULT)


def _expect_type(df: DataFrame, rule: str, col: str, wanted: type[T.DataType]) -> DataFrame:
    kind = df.schema[col].dataType
    bad = not isinstance(kind, wanted)
    return df.sparkSession.createDataFrame([(rule, col, int(bad), [kind.simpleString()] if bad else [])], RESULT)


def expect_text(df: DataFrame, col: str) -> DataFrame:
    """The column is a string column; checked on the schema, the sample names the other type."""
    return _expect_type(df, "text_type", col, T.StringType)


def expect_boolean(df: DataFrame, col: str) -> DataFrame:
    """The column is a boolean column; checked on the schema, the sample names the other type."""
    return _expect_type(df, "boolean_type", col, T.BooleanType)


def expect_no_duplicates(df: DataFrame, cols: list[str]) -> DataFrame:
    members = count_duplicates(df, cols).select(F.lit(None).cast("string").alias("value"), F.col("members").alias("n"))
    return _one(members, "exact_duplicates", "*")


def expect_unique(df: DataFrame, key: str) -> DataFrame:
    """Failures are the rows after the first of each key."""
    groups = df.groupBy(F.col(key).alias("value")).agg(F.count("*").alias("n")).filter("value IS NOT NULL AND n > 1")
    return _one(groups.select("value", (F.col("n") - 1).alias("n")), "unique", key)


def expect_referential(df: DataFrame, col: str, reference: DataFrame, key: str) -> DataFrame:
    """Every non-null value occurs in ``reference[key]``; joins distinct values only."""
    values = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n"))
    return _one(values.join(reference.select(F.col(key).alias("value")), "value", "left_anti"), "referential", col)


def phone_parts(df: DataFrame, col: str, *keep: str) -> DataFrame:
    """(keep, pos, part): the non-blank parts of ``;``-separated cells."""
    parts = df.select(*keep, F.posexplode(F.split(F.col(col), ";")).alias("pos", "part"))
    return parts.withColumn("part", strip(F.col("part"))).filter("part <> ''")


def expect_phone_parts(df: DataFrame, col: str, pattern: str = SINGLE_PHONE) -> DataFrame:
    bad = phone_parts(df, col).filter(~F.col("part").rlike(pattern))
    return _one(bad.groupBy(F.col("part").alias("value")).agg(F.count("*").alias("n")), "multi_value", col)


def first_phone_errors(df: DataFrame, col: str, row_col: str, n: int = 10) -> DataFrame:
    """The first ``n`` failing parts in row order."""
    bad = phone_parts(df, col, row_col).filter(~F.col("part").rlike(SINGLE_PHONE))
    return bad.orderBy(row_col, "pos").limit(n)


def expect_no_case_variants(df: DataFrame, cols: list[str]) -> DataFrame:
    """No two values of a column differ only by case; failures are surplus spellings, the sample has the groups' first ones."""
    values = df.select(*cols).unpivot([], cols, "column", "v").filter("v IS NOT NULL").distinct()
    groups = values.groupBy("column", F.upper("v").alias("u")).agg(F.count("*").alias("n"), F.min("v").alias("value"))
    surplus = groups.filter("n > 1").select(F.lit("case_variants").alias("rule"), "column", "value", (F.col("n") - 1).alias("n"))
    return _result(surplus, _named(df, [("case_variants", c) for c in cols]))
