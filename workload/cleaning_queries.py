"""Fuzzy duplicates, the cleaning pipeline and the quality report."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamiz.operators import expectations as ex, fuzzy, profile
from tamiz.plans import cleaning, deliver, report
from tamiz.plans.expectations import expect_clean
from tamiz.plans.rules import COLUMNS, DERIVED, DOMAINS
from tamiz.runtime import scratch_path
from tamiz.sources.tables import consolidate

from . import duck as d, table_queries as t
from .fixtures import CATALOG, PRODUCTS, RULES, SCHOOLS, duck, fixture
from .registry import query
from .table_queries import dim, schools

FX3, FX5, CAT = duck(SCHOOLS), duck(PRODUCTS), duck(CATALOG)
PRODUCT = dict(
    name="name", block=("block1", "block2"), address="address", phone="phone",
)
_PAIR_COLS = """a AS indice_a, b AS indice_b, x.code AS codigo_a, y.code AS codigo_b,
  x.name AS establecimiento_a, y.name AS establecimiento_b, s AS similitud_nombre,
  coalesce(x.address = y.address, false) AS misma_direccion,
  coalesce(x.phone = y.phone AND x.phone <> '', false) AS mismo_telefono,
  x.status AS status_a, y.status AS status_b"""
_PAIRS = f"""
WITH RECURSIVE fx AS ({FX5}), {d.pairs_ctes('fx', 'name', ['block1', 'block2'])},
full_pairs AS (SELECT {_PAIR_COLS} FROM pr JOIN fx x ON x.row_id = a JOIN fx y ON y.row_id = b),
decided AS (SELECT *, CASE
    WHEN misma_direccion AND mismo_telefono THEN '{fuzzy.DECISION_MERGE}'
    WHEN misma_direccion AND similitud_nombre >= 95 THEN '{fuzzy.DECISION_ADDRESS}'
    WHEN mismo_telefono AND similitud_nombre >= 95 THEN '{fuzzy.DECISION_PHONE}'
    WHEN NOT misma_direccion THEN '{fuzzy.DECISION_DISTINCT}'
    ELSE '{fuzzy.DECISION_UNCLEAR}' END AS decision FROM full_pairs)"""


def products(spark, sf):
    return fixture(spark, sf, PRODUCTS)


def _pairs(spark, sf):
    return fuzzy.fuzzy_pairs(products(spark, sf), "row_id", code="code", status="status", **PRODUCT)


@query("fuzzy_pairs", f"{_PAIRS} SELECT *, 'pendiente de revision manual' AS decision FROM full_pairs")
def fuzzy_pairs(spark, sf):
    return _pairs(spark, sf)


@query("fuzzy_decision", f"{_PAIRS} SELECT * FROM decided")
def fuzzy_decision(spark, sf):
    return fuzzy.with_decisions(_pairs(spark, sf))


@query("decision_summary", f"{_PAIRS} SELECT decision, count(*) AS pares FROM decided GROUP BY 1")
def decision_summary(spark, sf):
    return fuzzy.decision_summary(products(spark, sf), "row_id", **PRODUCT)


def clean_ctes() -> str:
    """CTEs up to ``cl``: row_id, the 24 clean columns and raw columns as r_<name>."""
    raw = ", ".join(f"{c} AS r_{c}" for c in COLUMNS)
    texts = ", ".join(f"{d.clean_text(c)} AS {c}" for c in d.TEXTS)
    unified = ", ".join(f"u_{c} AS ({d.unified('tx', c)})" for c in d.TEXTS)
    joins = " ".join(f"JOIN u_{c} ON u_{c}.variant = tx.{c}" for c in d.TEXTS)
    masked = ", ".join(
        f"CASE WHEN NOT {d.placeholder(f'u_{c}.canonical')} THEN u_{c}.canonical END AS {c}"
        for c in d.TEXTS[1:]
    )
    simple = ", ".join(f"upper({d.spaces('fx.' + c)}) AS {c}" for c in d.SIMPLE)
    return f"""
fx AS ({FX3}), {d.catalog_ctes(CAT)}, {d.places_cte('fx', 'pl')},
tx AS (SELECT row_id, {texts} FROM fx), {unified},
{d.phone_ctes('fx', 'row_id', 'TELEFONO')},
rw AS (SELECT row_id, {raw} FROM fx),
cl AS (SELECT fx.row_id, {d.spaces('fx.CODIGO')} AS CODIGO, nullif({d.spaces('fx.DISTRITO')}, '') AS DISTRITO,
  pl.dep AS DEPARTAMENTO, pl.mun AS MUNICIPIO, nullif(u_ESTABLECIMIENTO.canonical, '') AS ESTABLECIMIENTO,
  {masked}, {d.PHONE_JOINED} AS TELEFONO, {simple},
  {d.district('fx.DISTRITO')} AS DISTRITO_FORMATO,
  {d.district('fx.DISTRITO')} IN ('detallado', 'corto') AS DISTRITO_VALIDO,
  pl.mun_ok AS MUNICIPIO_VALIDO, fx.TELEFONO AS TELEFONO_ORIGINAL,
  CAST(len(numbers) AS INTEGER) AS TELEFONO_CANTIDAD, {d.PHONE_VALID} AS TELEFONO_VALIDO,
  {d.PHONE_NOTE} AS TELEFONO_OBSERVACION, rw.* EXCLUDE (row_id)
  FROM fx JOIN pl ON pl.row_id = fx.row_id JOIN tx ON tx.row_id = fx.row_id {joins}
  JOIN ph_done ON ph_done.row_id = fx.row_id JOIN rw ON rw.row_id = fx.row_id)"""


@query("clean_table", f"""WITH {clean_ctes()} SELECT row_id, {', '.join(COLUMNS + DERIVED)} FROM cl""")
def clean_table(spark, sf):
    return _cleaned(spark, sf)


def _cleaned(spark, sf):
    return cleaning.clean(schools(spark, sf), dim(spark, sf), RULES, ["row_id"], "row_id")


def _edge(c: str) -> str:
    return t.dq_sql("edge_spaces", c, f"{c} <> {d.strip(c)}", c, "cl")


@query("dq_clean", f"""WITH {clean_ctes()}, official AS (SELECT DISTINCT dc AS name FROM deps WHERE dc <> 'EUROPE')
{t.dq_union([
    t.dq_single('not_empty', '*', 'count(*) = 0', 'cl'), t.dq_columns(COLUMNS), t.dq_dups('cl'),
    *[_edge(c) for c in COLUMNS if c != 'TELEFONO'], *[t.dq_domain(c, v, 'cl') for c, v in DOMAINS.items()],
    t.dq_sql('pattern', 'CODIGO', f"NOT regexp_matches(CODIGO, '{d.CODE}')", 'CODIGO', 'cl'),
    t.dq_sql('not_null', 'CODIGO', 'CODIGO IS NULL', 'CODIGO', 'cl'),
    t.dq_sql('referential', 'DEPARTAMENTO', 'DEPARTAMENTO NOT IN (SELECT name FROM official)', 'DEPARTAMENTO', 'cl'),
    t.dq_parts('TELEFONO', 'cl'), t.dq_sql('flag_coherence', 'TELEFONO_VALIDO', 'TELEFONO IS NULL AND TELEFONO_VALIDO', "'true'", 'cl'),
    *t.dq_case('cl'), "SELECT 'boolean_type', 'TELEFONO_VALIDO', 0, NULL", "SELECT 'text_type', 'CODIGO', 0, NULL",
    t.dq_sql('integer', 'TELEFONO_CANTIDAD', 'try_cast(TELEFONO_CANTIDAD AS INTEGER) IS NULL AND TELEFONO_CANTIDAD IS NOT NULL', "''", 'cl'),
])}""")
def dq_clean(spark, sf):
    """All expectations on the finished table, with its real flag and number count; one department is not on the official list."""
    cleaned = _cleaned(spark, sf)
    official = dim(spark, sf).select(F.col("dept_canonical").alias("name")).filter("name <> 'EUROPE'").distinct()
    return t.joined(expect_clean(cleaned, official, "name"))


@query("dq_flag_coherence", f"""WITH {clean_ctes()}, few AS (SELECT TELEFONO_VALIDO, CASE WHEN TELEFONO_CANTIDAD < 2 THEN TELEFONO END AS TELEFONO FROM cl)
{t.dq_union([t.dq_sql('flag_coherence', 'TELEFONO_VALIDO', 'TELEFONO IS NULL AND TELEFONO_VALIDO', "'true'", 'few'), "SELECT 'boolean_type', 'TELEFONO_VALIDO', 0, NULL",
             "SELECT 'boolean_type', 'TELEFONO', 1, 'string'"])}""")
def dq_flag_coherence(spark, sf):
    """The real flag against a table that has lost the cells with several numbers."""
    one = F.when(F.col("TELEFONO_CANTIDAD") < 2, F.col("TELEFONO")).alias("TELEFONO")
    df = _cleaned(spark, sf).select("TELEFONO_VALIDO", one)
    kinds = ex.expect_boolean(df, "TELEFONO_VALIDO").unionByName(ex.expect_boolean(df, "TELEFONO"))
    return t.joined(ex.check(df, [ex.flag_coherent("TELEFONO", "TELEFONO_VALIDO")]).unionByName(kinds))


def _changed(c: str) -> str:
    return f"{c} IS DISTINCT FROM r_{c}"


def _affected(c: str) -> str:
    if c == "CODIGO":
        return f"count(*) FILTER (WHERE NOT regexp_matches(CODIGO, '{d.CODE}'))"
    if c == "DISTRITO":
        return "count(*) FILTER (WHERE DISTRITO_FORMATO IN ('vacio', 'incompleto'))"
    if c in d.TEXTS[1:]:
        return f"count(*) FILTER (WHERE {c} IS NULL)"
    if c == "TELEFONO":
        return ("count(*) FILTER (WHERE TELEFONO_CANTIDAD > 1) "
                "+ count(*) FILTER (WHERE NOT TELEFONO_VALIDO)")
    return f"count(*) FILTER (WHERE {_changed(c)})"


_LOG = " UNION ALL ".join(f"SELECT '{c}' AS variable, {_affected(c)} AS affected FROM cl" for c in COLUMNS)
_MAPPED = " UNION ALL ".join(
    f"SELECT '{c}' AS variable, count(*) AS mapped FROM u_{c} WHERE variant <> canonical" for c in d.TEXTS)


def _problem(c: str) -> str:
    """What the log says of a column, with its counts."""
    def count(condition: str) -> str:
        return f"count(*) FILTER (WHERE {condition})"

    texts = {
        "CODIGO": [_affected(c), " codes break the pattern"],
        "DISTRITO": [count("DISTRITO_FORMATO = 'vacio'"), " empty and ", count("DISTRITO_FORMATO = 'incompleto'"), " truncated"],
        "DEPARTAMENTO": [_affected(c), " not in canonical spelling"],
        "MUNICIPIO": [_affected(c), " not in canonical spelling; ", count("NOT MUNICIPIO_VALIDO"), " outside the catalogue"],
        "TELEFONO": [count("TELEFONO_CANTIDAD > 1"), " with several numbers; ", count("NOT TELEFONO_VALIDO"), " not valid"],
    }
    parts = texts.get(c, [_affected(c), " empty or placeholder" if c in d.TEXTS[1:] else " not in normal form"])
    return " || ".join(f"'{p}'" if i % 2 else f"({p})" for i, p in enumerate(parts))


def _log_row(c: str) -> str:
    other = cleaning.TEXT_STEP if c in d.TEXTS else cleaning.CATEGORY_STEP
    step, reason = cleaning.STEPS.get(c, other)
    return f"SELECT '{c}' AS variable, {_problem(c)} AS problem, '{step}' AS transformation, {_affected(c)} AS affected, '{reason}' AS reason FROM cl"


@query("transform_log", f"""WITH {clean_ctes()}, lg AS ({' UNION ALL '.join(_log_row(c) for c in COLUMNS)}), mp AS ({_MAPPED})
SELECT lg.*, mapped FROM lg LEFT JOIN mp ON mp.variable = lg.variable""")
def transform_log(spark, sf):
    raw = schools(spark, sf)
    aligned = cleaning.clean_aligned(raw, dim(spark, sf), RULES, ["row_id"], "row_id")
    return cleaning.transform_log(aligned, raw)


def _again(c: str) -> str:
    """Does a finished cell still differ from its normal form?"""
    if c == "TELEFONO":
        return "NOT regexp_full_match(TELEFONO, '[0-9]+(; [0-9]+)*')"
    if c in ("CODIGO", "DISTRITO"):
        return f"{c} <> {d.spaces(c)}"
    return f"{c} <> {d.clean_text(c) if c in d.TEXTS else 'upper(' + d.spaces(c) + ')'}"


def _report_sql() -> str:
    def long(src: str, prefix: str, missing) -> str:
        return " UNION ALL ".join(
            f"SELECT '{c}' AS col, count(*) FILTER (WHERE {missing(prefix + c)}) AS n FROM {src}" for c in COLUMNS
        )

    def shape(src: str, miss: str, variables: int) -> str:
        return (
            f"SELECT 'Registros' AS metric, count(*)::DOUBLE AS v FROM {src} "
            f"UNION ALL SELECT 'Variables', {variables} "
            f"UNION ALL SELECT 'Valores faltantes', sum(n) FROM {miss} "
            f"UNION ALL SELECT '% faltantes', round(100.0::DOUBLE * sum(n) / ((SELECT count(*) FROM {src}) * 17), 2) FROM {miss} "
            f"UNION ALL SELECT 'Variables con NA', count(*) FILTER (WHERE n > 0) FROM {miss}"
        )

    def rest(src: str, cols: list[str], name: str, pairs: str) -> str:
        return (
            "SELECT 'Duplicados exactos (fila completa)' AS metric, coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS v "
            f"FROM (SELECT count(*) AS n FROM {src} GROUP BY {', '.join(cols)}) "
            f"UNION ALL SELECT 'Posibles duplicados parciales (nombre similar, no identico)', count(*) FROM {pairs} "
            f"UNION ALL SELECT 'Establecimientos unicos (ESTABLECIMIENTO)', count(DISTINCT {name}) FROM {src}"
        )

    raw_pairs = _rename(d.pairs_ctes("fx", "ESTABLECIMIENTO", ["DEPARTAMENTO", "MUNICIPIO"]), "b")
    new_pairs = _rename(d.pairs_ctes("cl", "ESTABLECIMIENTO", ["DEPARTAMENTO", "MUNICIPIO"]), "a")
    variants = " UNION ALL ".join(
        f"SELECT count(DISTINCT {d.spaces(c)}) FILTER (WHERE {d.spaces(c)} <> upper({d.spaces(c)})) AS n FROM fx"
        for c in d.SIMPLE
    )
    again = " UNION ALL ".join(f"SELECT '{c}' AS col, count(*) FILTER (WHERE {_again(c)}) AS n FROM cl" for c in COLUMNS)
    return f"""
WITH RECURSIVE {clean_ctes()}, {raw_pairs}, {new_pairs}, lg AS ({_LOG}),
mb AS ({long('fx', '', d.placeholder)}), ma AS ({long('cl', '', lambda c: f'{c} IS NULL')}),
pv AS (SELECT DISTINCT {d.spaces('DEPARTAMENTO')} AS dv, {d.spaces('MUNICIPIO')} AS mv, dep, mun FROM pl),
cats AS (SELECT (SELECT count(*) FILTER (WHERE dep <> upper(dv)) FROM (SELECT DISTINCT dv, dep FROM pv))
  + (SELECT count(*) FILTER (WHERE mun <> upper(mv)) FROM pv) + (SELECT sum(n) FROM ({variants})) AS n),
again AS ({again}),
before AS ({shape('fx', 'mb', 17)} UNION ALL {rest('fx', COLUMNS, 'ESTABLECIMIENTO', 'pr_b')}
  UNION ALL SELECT 'Variables con formato inconsistente', count(*) FILTER (WHERE affected > 0) FROM lg
  UNION ALL SELECT 'Variables con tipo incorrecto', 0
  UNION ALL SELECT 'Categorias inconsistentes (variantes de escritura)', n FROM cats
  UNION ALL SELECT 'Errores corregidos (registros modificados)', sum(affected) FROM lg),
after AS ({shape('cl', 'ma', 24)} UNION ALL {rest('cl', COLUMNS, 'ESTABLECIMIENTO', 'pr_a')}
  UNION ALL SELECT 'Variables con formato inconsistente', count(*) FILTER (WHERE n > 0) FROM again
  UNION ALL SELECT 'Errores corregidos (registros modificados)', sum(n) FROM again
  UNION ALL SELECT m, 0 FROM (SELECT unnest(['Variables con tipo incorrecto', 'Categorias inconsistentes (variantes de escritura)']) AS m))
SELECT CAST(list_position([{', '.join("'" + m + "'" for m in report.METRICS)}], b.metric) AS INTEGER) AS ord,
  b.metric, CAST(b.v AS DOUBLE) AS before, CAST(a.v AS DOUBLE) AS after
FROM before b LEFT JOIN after a ON a.metric = b.metric ORDER BY 1"""


def _rename(ctes: str, suffix: str) -> str:
    """The pair CTEs under names of their own, so that two sets fit in one statement."""
    import re

    return re.sub(r"\b(keyed|cand|walk|scored|near|pr)\b", lambda m: f"{m.group(1)}_{suffix}", ctes)


@query("quality_report", _report_sql())
def quality_report(spark, sf):
    return report.quality_report(schools(spark, sf), dim(spark, sf), "row_id", RULES)


@query("duplicate_review", f"""
WITH RECURSIVE {clean_ctes()}, {d.pairs_ctes('cl', 'ESTABLECIMIENTO', ['DEPARTAMENTO', 'MUNICIPIO'])},
p AS (SELECT s, coalesce(x.DIRECCION = y.DIRECCION, false) AS sa, coalesce(x.TELEFONO = y.TELEFONO, false) AS sp
  FROM pr JOIN cl x ON x.row_id = a JOIN cl y ON y.row_id = b)
SELECT CASE WHEN sa AND sp THEN '{fuzzy.DECISION_MERGE}' WHEN sa AND s >= 95 THEN '{fuzzy.DECISION_ADDRESS}'
  WHEN sp AND s >= 95 THEN '{fuzzy.DECISION_PHONE}' WHEN NOT sa THEN '{fuzzy.DECISION_DISTINCT}'
  ELSE '{fuzzy.DECISION_UNCLEAR}' END AS decision, count(*) AS pares, count(*) AS listed,
  CAST(sum(s * 10) AS BIGINT) AS tenths FROM p GROUP BY 1""")
def duplicate_review(spark, sf):
    """The counted decisions beside the listed pairs they stand for; phones come from few numbers, so that some are shared."""
    cleaned = _cleaned(spark, sf)
    pairs, decisions = report.duplicate_review(cleaned, "row_id")
    listed = pairs.groupBy("decision").agg(
        F.count("*").alias("listed"), F.sum(F.round(F.col("similitud_nombre") * 10).cast("bigint")).alias("tenths")
    )
    return decisions.join(listed, "decision", "full")


def _report_rows(src: str, name: str, columns: list[str]) -> str:
    return f"SELECT '{name}' AS report, count(*) AS n, '{','.join(columns)}' AS header FROM {src}"


@query("published_reports", f"""
WITH RECURSIVE {clean_ctes()}, lg AS ({_LOG}),
rep AS (SELECT count(*) AS n FROM cl WHERE DEPARTAMENTO IS NOT NULL AND MUNICIPIO IS NOT NULL AND ESTABLECIMIENTO IS NOT NULL
  GROUP BY DEPARTAMENTO, MUNICIPIO, ESTABLECIMIENTO HAVING count(*) > 1),
far AS (SELECT count(DISTINCT DIRECCION) AS d FROM cl WHERE DEPARTAMENTO IS NOT NULL AND MUNICIPIO IS NOT NULL AND ESTABLECIMIENTO IS NOT NULL
  GROUP BY DEPARTAMENTO, MUNICIPIO, ESTABLECIMIENTO HAVING count(*) > 1 AND count(DISTINCT DIRECCION) > 1),
none AS (SELECT * FROM cl WHERE false)
{_report_rows('cl', 'clean', ['row_id', *COLUMNS, *DERIVED])}
UNION ALL {_report_rows('lg', 'transform_log', deliver.LOG)}
UNION ALL SELECT 'quality_report', 12, '{','.join(deliver.METRICS)}'
UNION ALL {_report_rows('none', 'duplicate_pairs', deliver.PAIRS)}
UNION ALL {_report_rows('rep', 'repeated_names', deliver.NAMES)}
UNION ALL {_report_rows('none', 'duplicate_decisions', deliver.DECISIONS)}
UNION ALL SELECT 'repeated names at several addresses', count(*), '' FROM far
UNION ALL SELECT 'affected cells', CAST(sum(affected) AS BIGINT), '' FROM lg""")
def published_reports(spark, sf):
    """Table and five reports, written, published and read back; at a threshold of 100 no pair is similar and not identical."""
    root = scratch_path(spark, "reports")
    deliver.publish(schools(spark, sf), dim(spark, sf), "row_id", root, RULES, threshold=100)
    found = []
    for name in ("clean", *deliver.REPORTS):
        df = deliver.read(spark, root, name)
        found.append(df.agg(F.lit(name).alias("report"), F.count("*").alias("n"), F.lit(",".join(df.columns)).alias("header")))
    names, log = deliver.read(spark, root, "repeated_names"), deliver.read(spark, root, "transform_log")
    far = profile.count_where(names, (F.col("direcciones_distintas").cast("int") > 1) & (F.col("parte") == 0))
    found.append(far.select(F.lit("repeated names at several addresses").alias("report"), "n", F.lit("").alias("header")))
    found.append(log.agg(F.lit("affected cells").alias("report"), F.sum(F.col("affected").cast("bigint")).alias("n"), F.lit("").alias("header")))
    return consolidate(found)


@query("align_metrics", """
SELECT 1 AS ord, 'orders' AS metric, CAST(count(*) AS DOUBLE) AS before,
  CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS after FROM orders
UNION ALL SELECT 2, 'lines', CAST(count(*) AS DOUBLE), NULL FROM lineitem""")
def align_metrics(spark, sf):
    from .fixtures import table

    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")

    def count(df, name):
        return df.agg(F.count("*").cast("double").alias("value")).select(F.lit(name).alias("metric"), "value")

    before = count(orders, "orders").unionByName(count(lines, "lines"))
    after = count(orders.filter("o_orderstatus = 'F'"), "orders")
    return report.align_metrics(before, after, ["orders", "lines"])
