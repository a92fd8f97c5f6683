"""Pattern checks and format classes of identifier columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import clean_spaces

# The identifier formats; \p{Nd} is every decimal digit, as \d in Python.
CODE_PATTERN = r"^\p{Nd}{2}-\p{Nd}{2}-\p{Nd}{4}-\p{Nd}{2}$"
CODE_ANYWHERE = r"\p{Nd}{2}-\p{Nd}{2}-\p{Nd}{4}-\p{Nd}{2}"
DISTRICT_DETAILED = r"^\p{Nd}{2}-\p{Nd}{2}-\p{Nd}{4}$"
DISTRICT_SHORT = r"^\p{Nd}{2}-\p{Nd}{3}$"
DISTRICT_TRUNCATED = r"^\p{Nd}{2}-$"

# Ordered format classes, first match wins.
DISTRICT_CLASSES = [
    ("detallado", DISTRICT_DETAILED),
    ("corto", DISTRICT_SHORT),
    ("incompleto", DISTRICT_TRUNCATED),
]
EMPTY_CLASS = "vacio"
UNKNOWN_CLASS = "formato_no_reconocido"
VALID_CLASSES = ["detallado", "corto"]


def matches_code(col: Column, pattern: str = CODE_PATTERN) -> Column:
    return col.rlike(pattern)


def classify_format(
    col: Column,
    classes: list[tuple[str, str]] = DISTRICT_CLASSES,
    empty: str = EMPTY_CLASS,
    unknown: str = UNKNOWN_CLASS,
) -> Column:
    """Name of the first pattern that matches the space-cleaned value."""
    value = clean_spaces(col)
    out = F.when(value == "", F.lit(empty))
    for name, pattern in classes:
        out = out.when(value.rlike(pattern), F.lit(name))
    return out.otherwise(F.lit(unknown))


def district_value(col: Column) -> Column:
    """Space-cleaned district; only an empty value becomes NULL, truncated ones stay."""
    return F.nullif(clean_spaces(col), F.lit(""))
