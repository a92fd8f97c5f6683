"""The cleaning pipeline: 17 text columns in, 24 columns out, and its log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.codes import classify_format, district_value, matches_code, VALID_CLASSES
from ..functions.phones import clean_phones
from ..functions.text import clean_spaces, clean_text, is_placeholder, normalize_category, null_where
from ..operators.places import PlaceRules, standardize_places
from ..operators.profile import ordinal
from ..operators.unify import mapped_spellings, unify_columns, unify_variants
from ..runtime import materialize
from .rules import COLUMNS, DERIVED, FREE_TEXT, PLACEHOLDER_TEXT, SIMPLE_CATEGORIES

RAW = "_raw"
# Fixed value: a finished phone cell.
PHONE_LIST = r"^[0-9]+(; [0-9]+)*\z"


def clean_free_text(df: DataFrame, col: str) -> DataFrame:
    """Clean, unify accent variants, then turn placeholders into NULL."""
    out = unify_variants(df.withColumn(col, clean_text(F.col(col))), col)
    return out.withColumn(col, null_where(F.col(col), is_placeholder(F.col(col))))


def clean_name(df: DataFrame, col: str) -> DataFrame:
    """As :func:`clean_free_text`, but only an empty name becomes NULL."""
    out = unify_variants(df.withColumn(col, clean_text(F.col(col))), col)
    return out.withColumn(col, F.nullif(F.col(col), F.lit("")))


def cleaned_text(df: DataFrame, *keep: str) -> DataFrame:
    """The free-text columns after cleaning, before spellings are unified."""
    return df.select(*keep, *[clean_text(F.col(c)).alias(c) for c in FREE_TEXT])


def clean_aligned(
    df: DataFrame, dim: DataFrame, rules: PlaceRules = PlaceRules(), keep: list[str] = [],
    row_col: str | None = None, spellings: DataFrame | None = None,
) -> DataFrame:
    """The cleaned columns with struct ``_raw`` (the input row) beside them.

    Steps are projections, the catalogue lookup and one join for the spellings
    of all free-text columns. ``keep`` names further columns, such as a row id, to
    carry along. ``row_col`` is a column that names each row; without one the input is
    written once with a number for each row. ``spellings`` is the state of
    earlier batches, see :func:`..operators.unify.spelling_state`.
    """
    if row_col is None:
        row_col = "_row"
        df = materialize(df.select(*dict.fromkeys([*keep, *COLUMNS]), F.monotonically_increasing_id().alias(row_col)), "numbered")
    simple = {
        "CODIGO": clean_spaces(F.col("CODIGO")),
        "DISTRITO": district_value(F.col("DISTRITO")),
        **{c: clean_text(F.col(c)) for c in FREE_TEXT},
        **{c: normalize_category(F.col(c)) for c in SIMPLE_CATEGORIES},
    }
    kind = classify_format(F.col("DISTRITO"))
    out = df.select(
        *dict.fromkeys([*keep, row_col]),
        *[simple[c].alias(c) if c in simple else F.col(c) for c in COLUMNS],
        kind.alias("DISTRITO_FORMATO"),
        kind.isin(VALID_CLASSES).alias("DISTRITO_VALIDO"),
        F.struct(*COLUMNS).alias(RAW),
    )
    out = standardize_places(out, dim, rules)
    out = unify_columns(out, row_col, FREE_TEXT, cleaned_text(df, row_col), spellings)
    out = clean_phones(out, "TELEFONO")
    masked = {c: null_where(F.col(c), is_placeholder(F.col(c))) for c in PLACEHOLDER_TEXT}
    masked["ESTABLECIMIENTO"] = F.nullif(F.col("ESTABLECIMIENTO"), F.lit(""))
    return out.select(
        *keep, *[masked[c].alias(c) if c in masked else F.col(c) for c in COLUMNS], *DERIVED, RAW
    )


def clean(
    df: DataFrame, dim: DataFrame, rules: PlaceRules = PlaceRules(), keep: list[str] = [],
    row_col: str | None = None, spellings: DataFrame | None = None,
) -> DataFrame:
    """The clean table: the 17 original and 7 derived columns."""
    return clean_aligned(df, dim, rules, keep, row_col, spellings).drop(RAW)


def changed(col: str) -> Column:
    """Is the cleaned value another than the raw one (NULL counts as a change)."""
    return ~F.col(col).eqNullSafe(F.col(f"{RAW}.{col}"))


def log_counters() -> dict[str, Column]:
    """Conditions counted for the log, by counter name; ``n_<column>`` is "affected"."""
    out = {
        "n_CODIGO": ~matches_code(F.col("CODIGO")),
        "n_DISTRITO": F.col("DISTRITO_FORMATO").isin("vacio", "incompleto"),
        "district_empty": F.col("DISTRITO_FORMATO") == "vacio",
        "district_truncated": F.col("DISTRITO_FORMATO") == "incompleto",
        "n_DEPARTAMENTO": changed("DEPARTAMENTO"),
        "n_MUNICIPIO": changed("MUNICIPIO"),
        "municipality_unknown": ~F.col("MUNICIPIO_VALIDO"),
        "n_ESTABLECIMIENTO": changed("ESTABLECIMIENTO"),
        "phone_many": F.col("TELEFONO_CANTIDAD") > 1,
        "phone_invalid": ~F.col("TELEFONO_VALIDO"),
    }
    out.update({f"n_{c}": F.col(c).isNull() for c in PLACEHOLDER_TEXT})
    out.update({f"n_{c}": changed(c) for c in SIMPLE_CATEGORIES})
    return out


def counter_aggs() -> list[Column]:
    return [F.count(F.when(cond, 1)).alias(name) for name, cond in log_counters().items()]


def affected_rows() -> dict[str, Column]:
    """Affected rows per column, from the counters.

    A phone cell that is both multi-valued and invalid counts twice.
    """
    out = {c: F.col(f"n_{c}") for c in COLUMNS if c != "TELEFONO"}
    out["TELEFONO"] = F.col("phone_many") + F.col("phone_invalid")
    return {c: out[c] for c in COLUMNS}


def _problems() -> dict[str, Column]:
    def text(*parts) -> Column:
        return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])

    out = {c: text(F.col(f"n_{c}"), " not in normal form") for c in ["ESTABLECIMIENTO", *SIMPLE_CATEGORIES]}
    out.update({c: text(F.col(f"n_{c}"), " empty or placeholder") for c in PLACEHOLDER_TEXT})
    out["CODIGO"] = text(F.col("n_CODIGO"), " codes break the pattern")
    out["DISTRITO"] = text(
        F.col("district_empty"), " empty and ", F.col("district_truncated"), " truncated"
    )
    out["DEPARTAMENTO"] = text(F.col("n_DEPARTAMENTO"), " not in canonical spelling")
    out["MUNICIPIO"] = text(
        F.col("n_MUNICIPIO"), " not in canonical spelling; ",
        F.col("municipality_unknown"), " outside the catalogue",
    )
    out["TELEFONO"] = text(
        F.col("phone_many"), " with several numbers; ", F.col("phone_invalid"), " not valid"
    )
    return out


# What each step does, and why its "affected" count is defined as it is.
STEPS = {
    "CODIGO": ("kept as text, pattern checked", "an identifier is not a quantity"),
    "DISTRITO": ("format classified, empty to NULL", "a missing number cannot be invented"),
    "DEPARTAMENTO": ("catalogue spelling", "unified to the correct form, not the frequent one"),
    "MUNICIPIO": ("catalogue spelling by department", "unknown names are flagged, not guessed"),
    "ESTABLECIMIENTO": ("text cleaned, accent variants unified", "no letter is changed"),
    "TELEFONO": ("split into numbers", "the original is kept for audit"),
}
TEXT_STEP = ("text cleaned, accent variants unified, placeholders to NULL", "a placeholder is a missing value")
CATEGORY_STEP = ("spaces and case normalised", "the check is explicit, not assumed")


def still_changed() -> dict[str, Column]:
    """By column: does a cell of the finished table still differ from its normal form?"""
    out = {c: F.col(c) != clean_text(F.col(c)) for c in FREE_TEXT}
    out.update({c: F.col(c) != normalize_category(F.col(c)) for c in ["DEPARTAMENTO", "MUNICIPIO", *SIMPLE_CATEGORIES]})
    out["CODIGO"] = F.col("CODIGO") != clean_spaces(F.col("CODIGO"))
    out["DISTRITO"] = F.col("DISTRITO") != district_value(F.col("DISTRITO"))
    out["TELEFONO"] = ~F.col("TELEFONO").rlike(PHONE_LIST)
    return {c: out[c] for c in COLUMNS}


def transform_log(aligned: DataFrame, source: DataFrame | None = None, counters: dict[str, int] | None = None) -> DataFrame:
    """One row per column: problem, transformation, affected rows, reason.

    All counters come from a single aggregation, or are given as ``counters`` when they were
    taken while the table was written. With ``source`` (the raw
    table) the free-text columns also state how many spellings were mapped.
    """
    if counters is None:
        one_row = aligned.agg(*counter_aggs())
    else:
        one_row = aligned.sparkSession.range(1).select(*[F.lit(counters[name]).cast("bigint").alias(name) for name in log_counters()])
    rows, problems = [], _problems()
    for col, affected in affected_rows().items():
        step, reason = STEPS.get(col, TEXT_STEP if col in PLACEHOLDER_TEXT else CATEGORY_STEP)
        rows.append(
            F.struct(
                F.lit(col).alias("variable"),
                problems[col].alias("problem"),
                F.lit(step).alias("transformation"),
                affected.alias("affected"),
                F.lit(reason).alias("reason"),
            )
        )
    log = one_row.select(F.inline(F.array(*rows)))
    if source is not None:
        mapped = mapped_spellings(cleaned_text(source), FREE_TEXT)
        log = log.join(mapped, "variable", "left")
    else:
        log = log.withColumn("mapped", F.lit(None).cast("bigint"))
    return log.select(
        "variable", "problem", "transformation", "affected", "mapped", "reason"
    ).orderBy(ordinal(F.col("variable"), COLUMNS))
