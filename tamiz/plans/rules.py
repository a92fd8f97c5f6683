"""The table layout and one rule record per column."""

from __future__ import annotations

from dataclasses import astuple, dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import normalize_text
from ..operators.profile import missing_report, ordinal

# Column names in file order.
COLUMNS = [
    "CODIGO", "DISTRITO", "DEPARTAMENTO", "MUNICIPIO", "ESTABLECIMIENTO", "DIRECCION",
    "TELEFONO", "SUPERVISOR", "DIRECTOR", "NIVEL", "SECTOR", "AREA", "STATUS", "MODALIDAD",
    "JORNADA", "PLAN", "DEPARTAMENTAL",
]
DERIVED = [
    "DISTRITO_FORMATO", "DISTRITO_VALIDO", "MUNICIPIO_VALIDO", "TELEFONO_ORIGINAL",
    "TELEFONO_CANTIDAD", "TELEFONO_VALIDO", "TELEFONO_OBSERVACION",
]
SIMPLE_CATEGORIES = [
    "NIVEL", "SECTOR", "AREA", "STATUS", "MODALIDAD", "JORNADA", "PLAN", "DEPARTAMENTAL",
]
CATEGORICAL = ["DEPARTAMENTO", "MUNICIPIO", *SIMPLE_CATEGORIES]
FREE_TEXT = ["ESTABLECIMIENTO", "DIRECCION", "SUPERVISOR", "DIRECTOR"]
PLACEHOLDER_TEXT = ["DIRECCION", "SUPERVISOR", "DIRECTOR"]

# Closed domains of the finished table.
DOMAINS = {
    "NIVEL": ["DIVERSIFICADO"],
    "AREA": ["URBANA", "RURAL", "SIN ESPECIFICAR"],
    "SECTOR": ["OFICIAL", "PRIVADO", "MUNICIPAL", "COOPERATIVA"],
    "STATUS": [
        "ABIERTA", "CERRADA DEFINITIVAMENTE", "CERRADA TEMPORALMENTE", "TEMPORAL TITULOS",
        "TEMPORAL NOMBRAMIENTO",
    ],
    "MODALIDAD": ["MONOLINGUE", "BILINGUE"],
}
# Domains the diagnosis expects.
DIAGNOSIS_DOMAINS = {"NIVEL": ["DIVERSIFICADO"], "AREA": ["URBANA", "RURAL"]}

# Departments with their codes in the source system.
DEPARTMENT_CODES = [
    ("16", "ALTA VERAPAZ"), ("15", "BAJA VERAPAZ"), ("04", "CHIMALTENANGO"),
    ("20", "CHIQUIMULA"), ("00", "CIUDAD CAPITAL"), ("02", "EL PROGRESO"),
    ("05", "ESCUINTLA"), ("01", "GUATEMALA"), ("13", "HUEHUETENANGO"), ("18", "IZABAL"),
    ("21", "JALAPA"), ("22", "JUTIAPA"), ("17", "PETEN"), ("09", "QUETZALTENANGO"),
    ("14", "QUICHE"), ("11", "RETALHULEU"), ("03", "SACATEPEQUEZ"), ("12", "SAN MARCOS"),
    ("06", "SANTA ROSA"), ("07", "SOLOLA"), ("10", "SUCHITEPEQUEZ"), ("08", "TOTONICAPAN"),
    ("19", "ZACAPA"),
]
# Official accented spelling by accent-free name; the others carry no accent.
DEPARTMENT_ACCENTS = {
    "PETEN": "PETÉN", "QUICHE": "QUICHÉ", "SACATEPEQUEZ": "SACATEPÉQUEZ", "SOLOLA": "SOLOLÁ",
    "SUCHITEPEQUEZ": "SUCHITEPÉQUEZ", "TOTONICAPAN": "TOTONICAPÁN",
}


def official_departments(spark: SparkSession) -> DataFrame:
    """(code, name, official): department codes with the plain and the accented name."""
    rows = [(code, name, DEPARTMENT_ACCENTS.get(name, name)) for code, name in DEPARTMENT_CODES]
    return spark.createDataFrame(rows, "code string, name string, official string")


# Departments whose regional office column is split into zones.
DEPENDENCIES = {
    "GUATEMALA": (
        ["GUATEMALA", "CIUDAD CAPITAL"],
        ["GUATEMALA NORTE", "GUATEMALA OCCIDENTE", "GUATEMALA SUR", "GUATEMALA ORIENTE"],
    ),
    "QUICHE": (["QUICHÉ"], ["QUICHÉ", "QUICHÉ NORTE"]),
}

# Logical types by column.
TYPE_CODE = "codigo alfanumerico (patron fijo ##-##-####-##)"
TYPE_DISTRICT = "codigo alfanumerico (formato variable: ##-### o ##-##-####)"
TYPE_PHONE = "texto (digitos con separadores no uniformes; puede haber varios numeros por celda)"
TYPE_CATEGORY = "categorico (dominio cerrado)"
TYPE_TEXT = "texto libre"
TYPE_OTHER = "texto"


def logical_type(name: Column) -> Column:
    """Logical type of a column, by its name."""
    return (
        F.when(name == "CODIGO", F.lit(TYPE_CODE))
        .when(name == "DISTRITO", F.lit(TYPE_DISTRICT))
        .when(name == "TELEFONO", F.lit(TYPE_PHONE))
        .when(name.isin(CATEGORICAL), F.lit(TYPE_CATEGORY))
        .when(name.isin(FREE_TEXT), F.lit(TYPE_TEXT))
        .otherwise(F.lit(TYPE_OTHER))
    )


@dataclass(frozen=True)
class Rule:
    variable: str
    issues: str
    transformations: str
    validation_rules: str
    expected_outcome: str
    risks: str


_CATEGORY = (
    "letter case or stray spaces may split a category",
    "trim spaces, upper-case",
    "value in the documented domain",
    "one spelling per category",
    "none: categories are neither merged nor renamed",
)
_PERSON = (
    "empty cells, placeholders and spellings that differ in accents",
    "clean text, unify accent variants, placeholders to NULL",
    "no placeholder left as text",
    "one spelling per person, missing values countable",
    "two people with equal letters are shown alike",
)
RULES = [
    Rule("CODIGO", "identifier must keep dashes and leading zeros", "trim spaces, keep as text",
         "pattern ##-##-####-##, unique", "stable key", "a cast to number would destroy it"),
    Rule("DISTRITO", "empty and truncated codes, two valid formats",
         "trim spaces, classify the format, empty to NULL", "valid formats are ##-### and ##-##-####",
         "every defect is visible in the format column", "truncated codes are kept, not completed"),
    Rule("DEPARTAMENTO", "missing accents", "look up the canonical spelling",
         "member of the catalogue", "official spelling", "unknown names keep their folded form"),
    Rule("MUNICIPIO", "accent and case variants, names outside the catalogue",
         "look up by department and folded name", "member of the catalogue of its department, or a zone",
         "official spelling or a false flag", "misspelt names are flagged, not guessed"),
    Rule("ESTABLECIMIENTO", "wrapping quotes, invisible characters, accent variants",
         "clean text, unify accent variants, empty to NULL", "no wrapping quotes",
         "stable school name", "placeholders stay as text"),
    Rule("DIRECCION", "placeholders and loose punctuation at the ends",
         "clean text, unify accent variants, placeholders to NULL", "no placeholder, no edge space",
         "readable address", "only the ends of the text are changed"),
    Rule("TELEFONO", "several numbers per cell, abbreviated suffixes, fax, extensions, ranges",
         "split into numbers, complete suffixes, keep the original", "each number has 7 or 8 digits",
         "usable and auditable numbers", "a completed suffix may be wrong"),
    Rule("SUPERVISOR", *_PERSON),
    Rule("DIRECTOR", *_PERSON),
    *[Rule(c, *_CATEGORY) for c in SIMPLE_CATEGORIES],
]


def plan_table(df: DataFrame, row_filter: Column | None = None) -> DataFrame:
    """The rule records with the blank cells and text to be trimmed that ``df`` shows."""
    data = df if row_filter is None else df.filter(row_filter)
    names = [f.name for f in fields(Rule)]
    schema = ", ".join(f"{n} string" for n in names)
    rules = df.sparkSession.createDataFrame([astuple(r) for r in RULES], schema)
    blank = missing_report(data, COLUMNS).select(F.col("column").alias("variable"), "missing_count")
    untidy = data.agg(
        *[F.count(F.when(F.col(c) != normalize_text(F.col(c)), 1)).alias(c) for c in COLUMNS]
    ).unpivot([], COLUMNS, "variable", "untidy_count")
    return (
        rules.join(blank, "variable", "left")
        .join(untidy, "variable", "left")
        .orderBy(ordinal(F.col("variable"), COLUMNS))
    )
