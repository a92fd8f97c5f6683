"""Dirty inputs as deterministic projections of the given tables.

Each fixture is one SELECT that Spark and DuckDB both run, so that the two
sides of a check start from the same rows. Table names are ``{name}`` fields.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tamiz.operators.places import PlaceRules
from tamiz.runtime import scratch_path

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
TAB, NBSP, ZWSP = "\t", "\u00a0", "\u200b"


def cases(selector: str, branches: list[str]) -> str:
    """CASE over ``selector`` modulo the number of branches."""
    whens = " ".join(f"WHEN {i} THEN {b}" for i, b in enumerate(branches))
    return f"CASE ({selector}) % {len(branches)} {whens} END"


def base_name(word: str, k: str) -> str:
    """A clean name that repeats every 640 keys."""
    g = f"(CAST(floor(({k}) / 16) AS BIGINT) % 40)"
    return f"concat('{word} JOSE ', chr(CAST(65 + {g} % 26 AS INT)), ' ', CAST({g} AS STRING))"


def dirty(base: str, k: str) -> str:
    """The name in column ``base`` with one of 16 kinds of defect."""
    return cases(k, [
        base,
        f"concat('  ', {base}, '  ')",
        f"replace({base}, ' ', '  ')",
        f"replace({base}, ' ', '{TAB}')",
        f"concat('{NBSP}', replace({base}, ' ', '{NBSP}'))",
        f"replace({base}, 'JOSE', 'JO{ZWSP}SE')",
        f"""concat('"', {base}, '"')""",
        f"""replace({base}, 'JOSE', '"JOSE"')""",
        f"concat(', ', {base})",
        f"concat({base}, ' ;')",
        f"concat({base}, '.')",
        f"replace({base}, 'JOSE', 'JOSÈ')",
        f"replace({base}, 'JOSE', 'JOSÉ')",
        "''",
        cases(k, ["'---'", "'S/D'", "'XXX'", "'0'", "'n/a'"]),
        f"replace({base}, 'JOSE', CASE WHEN ({k}) % 32 < 16 THEN 'MUÑOZ' ELSE 'MUNOZ' END)",
    ])


def phone_parts(c: str) -> str:
    """Columns d8, e8, d7, e7, d6: numbers of that many digits from ``c``."""
    digits = [("d8", "2", 7), ("e8", "5", 7), ("d7", "3", 6), ("e7", "4", 6), ("d6", "6", 5)]
    return ", ".join(
        f"concat('{lead}', lpad(CAST(({c}) % {10 ** n} AS STRING), {n}, '0')) AS {name}"
        for name, lead, n in digits
    )


def phone(k: str) -> str:
    """A phone cell in one of 24 layouts, from the columns of :func:`phone_parts`."""
    return cases(k, [
        "d8",
        "d7",
        "d6",
        "concat(d8, '-', e8)",
        "concat(d7, '- ', e7)",
        "concat(substr(d8, 1, 4), '-', substr(d8, 5, 4))",
        "concat(substr(d7, 1, 3), '-', substr(d7, 4, 4))",
        "concat(d8, '-73')",
        "concat(d8, '-73-81')",
        "concat(substr(d8, 1, 4), '-', substr(d8, 4, 5))",
        "concat(d8, '-', e8, '-', d7)",
        "concat(d8, ',', e8)",
        "concat(' ', d8, ', ', e7)",
        "concat(d8, '/', e8, '/43')",
        "concat(d8, ' Y ', e8)",
        "concat(d7, ' y ', e7)",
        "concat(d8, '  ', e8)",
        "concat(d8, ' FAX ', e8)",
        "concat('FAX ', d8)",
        "concat(d8, ' EXT. 12')",
        "concat(d6, ' ESTX. 225-250')",
        "concat(d8, ' AL 40')",
        "concat(d8, ', casa')",
        cases(k, ["''", "'-'", "'0'"]),
    ])


_K = "c_custkey"
_BASES = ", ".join(
    f"{base_name(word, key)} AS {name}"
    for name, word, key in (
        ("b_name", "LICEO", _K), ("b_address", "AVENIDA", f"{_K} + 3"),
        ("b_supervisor", "MARIA", f"{_K} + 7"), ("b_director", "JUAN", f"{_K} + 11"),
    )
)

DIRTY_TEXT = f"""
SELECT {_K} AS row_id,
  {dirty('b_name', _K)} AS name,
  {dirty('b_address', f'{_K} + 3')} AS address,
  {dirty('b_supervisor', f'{_K} + 7')} AS supervisor,
  {dirty('b_director', f'{_K} + 11')} AS director
FROM (SELECT {_K}, {_BASES} FROM {{customer}}) t"""

PHONES = f"""
SELECT o_orderkey AS row_id, {phone('o_orderkey')} AS telefono
FROM (SELECT o_orderkey, {phone_parts('o_custkey')} FROM {{orders}}) t"""

_NN = "lpad(CAST(n_nationkey AS STRING), 2, '0')"
_RR = "lpad(CAST(r_regionkey AS STRING), 2, '0')"
_CODE = (
    f"concat({_NN}, '-', {_RR}, '-', lpad(CAST({_K} % 10000 AS STRING), 4, '0'), '-', "
    f"lpad(CAST(CAST(floor({_K} / 10000) AS BIGINT) % 100 AS STRING), 2, '0'))"
)
_DETAILED = f"concat({_NN}, '-', {_RR}, '-', lpad(CAST({_K} % 10000 AS STRING), 4, '0'))"
_SHORT = f"concat({_NN}, '-', lpad(CAST({_K} % 1000 AS STRING), 3, '0'))"
_ACCENTED = "CASE WHEN r_name LIKE 'A%' THEN concat('Á', substr(r_name, 2)) ELSE r_name END"
_TOWN = "replace(n_name, 'NATION', 'NACION')"

_SCHOOL_COLUMNS = f"""
  CASE WHEN {_K} % 97 = 0 THEN replace(code, '-', '/')
       WHEN {_K} % 10 = 3 THEN concat(' ', code) ELSE code END AS CODIGO,
  {cases(_K, ["''", "detailed", "detailed", "detailed", "detailed", "short", "short", "short", "short",
              f"concat({_NN}, '-')", "'S/N'"])} AS DISTRITO,
  {cases(_K, ["r_name", "lower(r_name)", "concat(' ', r_name, ' ')", _ACCENTED])} AS DEPARTAMENTO,
  CASE WHEN {_K} % 53 = 0 THEN concat('Desconocido ', CAST(n_nationkey AS STRING))
       WHEN r_name = 'MIDDLE EAST' AND {_K} % 7 = 0
         THEN concat('zona ', CAST({_K} % 30 + 1 AS STRING))
       WHEN r_name = 'MIDDLE EAST' THEN concat('ZONA ', CAST({_K} % 30 + 1 AS STRING))
       ELSE {cases(_K, [_TOWN, f"lower({_TOWN})", "replace(n_name, 'NATION', 'NACIÓN')",
                        f"concat({_TOWN}, '  ')", _TOWN])} END AS MUNICIPIO,
  {dirty('b_name', _K)} AS ESTABLECIMIENTO,
  {dirty('b_address', f'{_K} + 3')} AS DIRECCION,
  {phone(_K)} AS TELEFONO,
  {dirty('b_supervisor', f'{_K} + 7')} AS SUPERVISOR,
  {dirty('b_director', f'{_K} + 11')} AS DIRECTOR,
  CASE WHEN {_K} % 50 = 0 THEN 'BASICO' WHEN {_K} % 9 = 0 THEN 'Diversificado'
       ELSE 'DIVERSIFICADO' END AS NIVEL,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'OFICIAL' WHEN 'MACHINERY' THEN 'PRIVADO'
       WHEN 'HOUSEHOLD' THEN 'Municipal' WHEN 'AUTOMOBILE' THEN ' COOPERATIVA'
       ELSE c_mktsegment END AS SECTOR,
  {cases(_K, ["'URBANA'", "'RURAL'", "'Sin  especificar'"])} AS AREA,
  {cases(_K, ["'ABIERTA'", "'CERRADA DEFINITIVAMENTE'", "'CERRADA TEMPORALMENTE'",
              "'TEMPORAL TITULOS'", "'TEMPORAL NOMBRAMIENTO'", "'ABIERTA'", "'abierta'"])} AS STATUS,
  {cases(_K, ["'MONOLINGUE'", "'BILINGUE'"])} AS MODALIDAD,
  {cases(_K, ["'DOBLE'", "'MATUTINA'", "'VESPERTINA'", "'NOCTURNA'"])} AS JORNADA,
  {cases(_K, ["'DIARIO(REGULAR)'", "'FIN DE SEMANA'", "'A DISTANCIA'"])} AS PLAN,
  CASE WHEN {_K} % 211 = 0 THEN 'EUROPE NORTE'
       WHEN r_name = 'EUROPE' THEN {cases(_K, ["'EUROPE NORTE'", "'EUROPE SUR'"])}
       ELSE {_ACCENTED} END AS DEPARTAMENTAL
FROM (SELECT customer.*,
    {_BASES}, {phone_parts(f'{_K} % 500 + 1000')}
  FROM (SELECT c.*, n_nationkey, n_name, r_regionkey, r_name,
      {_CODE} AS code, {_DETAILED} AS detailed, {_SHORT} AS short
    FROM {{customer}} c JOIN {{nation}} n ON c_nationkey = n_nationkey
      JOIN {{region}} r ON n_regionkey = r_regionkey) customer) t"""

# Every 101st row occurs twice; row ids are even, those of the copies odd.
SCHOOLS = f"""
SELECT 2 * {_K} AS row_id, {_SCHOOL_COLUMNS}
UNION ALL
SELECT 2 * {_K} + 1 AS row_id, {_SCHOOL_COLUMNS} WHERE {_K} % 101 = 0"""

CATALOG = """
SELECT CASE WHEN r_name LIKE 'A%' THEN concat('Á', lower(substr(r_name, 2))) ELSE r_name END
    AS department,
  replace(n_name, 'NATION', 'Nación') AS municipality
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey"""

# One region plays the department that is reported by zone.
RULES = PlaceRules(zoned_department="MIDDLE EAST")
REGIONAL = {"EUROPE": (["EUROPE"], ["EUROPE NORTE", "EUROPE SUR"])}

_NAME = (
    "concat(upper(p_name), ' ', p_type, ' ', "
    + cases("p_size", ["'NORTE'", "'SUR'", "'CENTRO'", "'ORIENTE'", "'OCCIDENTE'"])
    + ", ' ', CAST(p_size AS STRING))"
)
PRODUCTS = f"""
SELECT p_partkey AS row_id, CAST(p_partkey AS STRING) AS code, p_brand AS block1, p_type AS block2,
  CASE WHEN p_partkey % 89 = 0 THEN NULL
       WHEN p_partkey % 7 = 0 THEN concat(substr({_NAME}, 1, 3), substr({_NAME}, 5))
       WHEN p_partkey % 11 = 0 THEN concat(p_type, ' ', replace({_NAME}, p_type, ''))
       ELSE {_NAME} END AS name,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE concat('CALLE ', CAST(p_size % 3 AS STRING)) END AS address,
  CASE WHEN p_partkey % 13 = 5 THEN NULL WHEN p_partkey % 13 = 6 THEN ''
       ELSE concat('2222000', CAST(p_partkey % 4 AS STRING)) END AS phone,
  {cases('p_partkey', ["'ABIERTA'", "'CERRADA'"])} AS status
FROM {{part}}"""

_CELLS = (
    f"concat('<td class=\"c\">', {_CODE}, '</td><TD>', {_SHORT}, '</TD>"
    "<td><b>', r_name, '</b></td><td> ', n_name, ' </td>"
    "<td>LICEO &quot;', c_name, '&quot; &amp; C&iacute;a &#209;&#x41;</td>', "
    + " || ".join(f"'<td>v{i}&nbsp;  x</td>'" for i in range(6, 18))
    + ")"
)
HTML_FILES = f"""
SELECT n_name AS source, {_K} AS doc_id,
  concat('<html><script type="x">if (a<b) document.write("<tr><td>no</td></tr>");</script>',
    '<table><tr><th>h</th></tr><!-- <tr><td>no</td></tr> --><tr><td>Listado ',
    CAST({_K} AS STRING), '</td></tr>',
    '<TR><td>Codigo</td><td>DISTRITO</td><td>Departamento</td><td>x</td>',
    '<td> Establecimiento </td></TR>',
    '<tr>', {_CELLS}, '</tr>',
    '<tr class="a"><td>', {_CODE}, '</td><td>corta</td></tr>',
    '<tr>', {_CELLS}, '<td>sobra</td><td>sobra</td></tr>',
    '<tr><td>Total</td><td>3</td></tr><tr></tr></table></html>') AS html
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey
  JOIN {{region}} ON n_regionkey = r_regionkey"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a table that one task turns into rows of a fixture, and rows in a file of a fixture.
ROWS_IN_PART = 20_000


def spread(df: DataFrame) -> DataFrame:
    """The rows of a stored table, dealt to parts of about ROWS_IN_PART rows.

    Tables are stored compactly: a file of a few megabytes, read by one task, can hold a million rows.
    """
    parts = -(-df.count() // ROWS_IN_PART)
    return df.repartition(parts) if parts > 1 else df


_STAGED: dict[tuple[str, str, str], str] = {}


def fixture(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """The rows of a fixture, all of them, written once per session.

    A raw table is stored data. Staging it keeps the expressions that make the
    dirt out of the plans of the queries that clean it. Its files are many enough for all tasks to read.
    """
    key = (spark.sparkContext.applicationId, sf_dir, text)
    if key not in _STAGED:
        used = {t: spread(table(spark, sf_dir, t)) for t in TABLES if "{" + t + "}" in text}
        path = scratch_path(spark, "fixture")
        spark.sql(text, **used).write.option("maxRecordsPerFile", ROWS_IN_PART).parquet(path)
        _STAGED[key] = path
    return spark.read.parquet(_STAGED[key])


def duck(text: str) -> str:
    """The same SELECT over tables registered under their own names."""
    return text.format(**{t: t for t in TABLES})
