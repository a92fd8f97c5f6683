"""Merge spelling variants that differ only in accents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import fold_ascii
from ..runtime import materialize


def accent_count(col: Column) -> Column:
    """Number of upper-case acute vowels (the only ones that rank a variant)."""
    return F.length(col) - F.length(F.translate(col, "ÁÉÍÓÚ", ""))


def canonical_variants(df: DataFrame, col: str) -> DataFrame:
    """(key, canonical) for each accent-folded key written in more than one way.

    The canonical spelling has most acute vowels, then the highest code points.
    One shuffle of one column, aggregated before it; a group has several
    spellings exactly when its smallest and largest differ.
    """
    value = F.col(col)
    return (
        df.select(value)
        .filter(value.isNotNull())
        .groupBy(fold_ascii(value).alias("key"))
        .agg(
            F.max(F.struct(accent_count(value).alias("n"), value.alias("v"))).alias("best"),
            F.min(value).alias("low"),
            F.max(value).alias("high"),
        )
        .filter("low <> high")
        .select("key", F.col("best.v").alias("canonical"))
    )


def variant_map(df: DataFrame, col: str) -> DataFrame:
    """(variant, canonical) for each value that another spelling replaces."""
    values = df.select(F.col(col).alias("variant")).distinct()
    return (
        values.withColumn("key", fold_ascii(F.col("variant")))
        .join(canonical_variants(df, col), "key")
        .filter(F.col("variant") != F.col("canonical"))
        .select("variant", "canonical")
    )


def mapped_spellings(df: DataFrame, cols: list[str]) -> DataFrame:
    """(variable, mapped): how many spellings of each column another one replaces.

    All columns in one scan. Of the n spellings of a key, n - 1 are replaced.
    """
    values = df.select(*cols).unpivot([], cols, "variable", "value").filter("value IS NOT NULL")
    keys = values.distinct().groupBy("variable", fold_ascii(F.col("value")).alias("key"))
    per_key = keys.agg((F.count("*") - 1).alias("surplus"))
    return per_key.groupBy("variable").agg(F.sum("surplus").alias("mapped"))


def apply_canonical(df: DataFrame, col: str, canonical: DataFrame) -> DataFrame:
    """Replace values whose folded key has a canonical spelling; others and NULL stay.

    No broadcast is forced: Spark broadcasts the table when its size allows and
    splits skewed partitions of the fact side otherwise.
    """
    m = canonical.select(F.col("key").alias("_key"), F.col("canonical").alias("_canonical"))
    merged = F.coalesce("_canonical", col).alias(col)
    return df.join(m, fold_ascii(F.col(col)) == F.col("_key"), "left").select(
        *[merged if c == col else F.col(c) for c in df.columns]
    )


def unify_variants(df: DataFrame, col: str) -> DataFrame:
    return apply_canonical(df, col, canonical_variants(df, col))


def spelling_state(df: DataFrame, cols: list[str]) -> DataFrame:
    """(variable, key, best, low, high) of all columns: what the spellings seen so far say about each key.

    One scan, one narrow shuffle of distinct keys. States of several batches add
    up, see :func:`merged_states`; empty cells are in none.
    """
    value = F.col("value")
    cells = df.select(*cols).unpivot([], cols, "variable", "value").filter("value <> ''")
    return cells.groupBy("variable", fold_ascii(value).alias("key")).agg(
        F.max(F.struct(accent_count(value).alias("n"), value.alias("v"))).alias("best"),
        F.min(value).alias("low"), F.max(value).alias("high"),
    )


def merged_states(states: list[DataFrame]) -> DataFrame:
    """The state of all batches together."""
    return reduce(DataFrame.unionByName, states).groupBy("variable", "key").agg(
        F.max("best").alias("best"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def dictionary(state: DataFrame) -> DataFrame:
    """(variable, key, canonical) for each key written in more than one way."""
    return state.filter("low <> high").select("variable", "key", F.col("best.v").alias("canonical"))


def replacements(df: DataFrame, row_col: str, cols: list[str], spellings: DataFrame) -> DataFrame:
    """(row_col, fix): for rows with a spelling that another one replaces, the new text by column.

    One narrow join of all columns; empty cells stay out of it.
    """
    cells = df.select(row_col, *cols).unpivot([row_col], cols, "variable", "value").filter("value <> ''")
    found = cells.withColumn("key", fold_ascii(F.col("value"))).join(spellings, ["variable", "key"]).filter("value <> canonical")
    return found.groupBy(row_col).agg(F.map_from_entries(F.collect_list(F.struct("variable", "canonical"))).alias("fix"))


def unify_columns(
    df: DataFrame, row_col: str, cols: list[str], source: DataFrame | None = None, state: DataFrame | None = None
) -> DataFrame:
    """Replace the values of all ``cols`` that have a better spelling.

    ``row_col`` names each row. ``source`` has the row name and the columns as a narrow scan, by
    default ``df`` itself; ``state`` is what earlier batches have seen, from :func:`spelling_state`.
    The dictionary and the rows to change are written once, so that Spark knows their
    size and moves the wide rows only when the rows to change are too many to broadcast.
    """
    source = df if source is None else source
    seen = spelling_state(source, cols)
    spellings = materialize(dictionary(seen if state is None else merged_states([state, seen])), "spellings")
    fixes = materialize(replacements(source, row_col, cols, spellings), "fixes")
    fixes = fixes.select(F.col(row_col).alias("_fixed"), "fix")
    merged = {c: F.coalesce(F.try_element_at("fix", F.lit(c)), F.col(c)).alias(c) for c in cols}
    return df.join(fixes, F.col(row_col) == F.col("_fixed"), "left").select(*[merged.get(c, F.col(c)) for c in df.columns])
