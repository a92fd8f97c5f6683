"""What the finished table must meet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from ..operators import expectations as ex
from ..operators.consistency import dependency_check
from .rules import COLUMNS, DEPENDENCIES, DOMAINS, SIMPLE_CATEGORIES, official_departments

#: Categories checked for spellings that differ by case.
CASED = ["DEPARTAMENTO", *[c for c in SIMPLE_CATEGORIES if c != "DEPARTAMENTAL"]]


def expect_clean(
    df: DataFrame, departments: DataFrame | None = None, key: str = "official", domains: dict[str, list[str]] = DOMAINS
) -> DataFrame:
    """(rule, column, failures, sample) of all expectations on the finished table, failing or not.

    ``departments`` is the official list, by default the fixed one. Row rules share one scan.
    """
    if departments is None:
        departments = official_departments(df.sparkSession)
    rules = [
        *ex.no_edge_spaces([c for c in COLUMNS if c != "TELEFONO"]), *ex.in_domain(domains),
        ex.has_pattern("CODIGO"), ex.not_null("CODIGO"),
        ex.flag_coherent("TELEFONO", "TELEFONO_VALIDO"), ex.integer_text("TELEFONO_CANTIDAD"),
    ]
    return reduce(DataFrame.unionByName, [
        ex.expect_not_empty(df), ex.expect_columns(df, COLUMNS), ex.expect_no_duplicates(df, COLUMNS), ex.check(df, rules),
        ex.expect_referential(df, "DEPARTAMENTO", departments, key), ex.expect_phone_parts(df, "TELEFONO"),
        ex.expect_no_case_variants(df, CASED), ex.expect_boolean(df, "TELEFONO_VALIDO"), ex.expect_text(df, "CODIGO"),
    ])


def check_offices(df: DataFrame) -> DataFrame:
    """Do department and regional office of the finished table agree, for the departments that have several offices?"""
    return dependency_check(df, DEPENDENCIES)
