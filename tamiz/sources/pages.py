"""Fields, first matches and hit counts from page markup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.codes import CODE_ANYWHERE

# Hidden form fields (name, value), and the first option of the
# municipality selector, as the source system writes them.
HIDDEN_FIELD = (
    r'(?i)<input\s+type="hidden"\s+name="([^"]+)"\s+id="[^"]*"\s+value="([^"]*)"'
)
FIRST_OPTION = (
    r'(?is)<select[^>]*name="_ctl0:ContentPlaceHolder1:cmbMunicipio"[^>]*>'
    r'\s*<option[^>]*value="([^"]*)"'
)


def fields_map(html: Column, pattern: str = HIDDEN_FIELD) -> Column:
    """map name -> value from a pattern with two groups; the last value of a name wins."""
    names = F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
    values = F.regexp_extract_all(html, F.lit(pattern), F.lit(2))
    # A name whose last position is p occurs at size - p in the reversed list.
    backwards, n = F.reverse(names), F.size(names)
    distinct = F.array_distinct(names)
    last = F.transform(
        distinct, lambda name: F.get(values, (n - F.array_position(backwards, name)).cast("int"))
    )
    return F.map_from_arrays(distinct, last)


def first_match(html: Column, pattern: str = FIRST_OPTION, group: int = 1) -> Column:
    """The group of the first match, ``''`` without one."""
    return F.regexp_extract(html, pattern, group)


def count_hits(html: Column, pattern: str = CODE_ANYWHERE) -> Column:
    return F.regexp_count(html, F.lit(pattern))


def accept_pages(df: DataFrame, html: str = "html", pattern: str = CODE_ANYWHERE) -> DataFrame:
    """Add ``hits`` and ``accepted``; a page without hits is not accepted."""
    hits = count_hits(F.col(html), pattern)
    return df.withColumn("hits", hits).withColumn("accepted", F.col("hits") > 0)
