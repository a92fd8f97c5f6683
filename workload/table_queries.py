"""Profiles, duplicates, catalogues, consistency and expectations."""

from __future__ import annotations

from dataclasses import astuple, fields

from pyspark.sql import functions as F

from tamiz.functions import text
from tamiz.operators import consistency, duplicates, expectations as ex, places, profile, repeated
from tamiz.plans import rules as r

from . import duck as d
from .fixtures import CATALOG, DIRTY_TEXT, REGIONAL, RULES, SCHOOLS, duck, fixture, table
from .registry import query

FX1, FX3, CAT = duck(DIRTY_TEXT), duck(SCHOOLS), duck(CATALOG)
COLS, SIMPLE, CATEGORICAL = r.COLUMNS, r.SIMPLE_CATEGORIES, r.CATEGORICAL


def schools(spark, sf):
    return fixture(spark, sf, SCHOOLS)


def dim(spark, sf):
    return places.catalog_dim(fixture(spark, sf, CATALOG))


def longform(src: str, cols: list[str], expr, extra: str = "row_id") -> str:
    """(column, value) rows of ``cols`` in DuckDB, one SELECT per column."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS col, {extra}, {expr(c)} AS v FROM {src}" for c in cols
    )


def _top_sql(cols: list[str], expr) -> str:
    return f"""
WITH fx AS ({FX3}), l AS ({longform('fx', cols, expr)}),
g AS (SELECT col, v, count(*) AS n, min(row_id) AS f FROM l GROUP BY 1, 2),
o AS (SELECT *, row_number() OVER (PARTITION BY col ORDER BY n DESC, f) AS rn FROM g WHERE v <> ''),
s AS (SELECT col, sum(CASE WHEN v <> '' THEN 1 ELSE 0 END) AS u,
  sum(CASE WHEN v <> '' THEN n ELSE 0 END) AS t FROM g GROUP BY 1)"""


@query("profile_columns", f"""{_top_sql(COLS, d.norm)}
SELECT s.col AS "column",
  CASE s.col WHEN 'CODIGO' THEN '{r.TYPE_CODE}' WHEN 'DISTRITO' THEN '{r.TYPE_DISTRICT}'
    WHEN 'TELEFONO' THEN '{r.TYPE_PHONE}' WHEN 'ESTABLECIMIENTO' THEN 'texto libre'
    WHEN 'DIRECCION' THEN 'texto libre' WHEN 'SUPERVISOR' THEN 'texto libre'
    WHEN 'DIRECTOR' THEN 'texto libre' ELSE 'categorico (dominio cerrado)' END AS tipo_dato_detectado,
  CAST(u AS BIGINT) AS valores_unicos, CAST(t AS BIGINT) AS valores_no_vacios,
  coalesce(o.v, '') AS valor_mas_frecuente, CAST(coalesce(o.n, 0) AS BIGINT) AS frecuencia_top
FROM s LEFT JOIN o ON o.col = s.col AND rn = 1""")
def profile_columns(spark, sf):
    return profile.profile_columns(schools(spark, sf), COLS, "row_id", r.logical_type)


@query("category_summary", f"""{_top_sql(CATEGORICAL, lambda c: f'upper({d.norm(c)})')}
SELECT s.col AS "column", CAST(u AS BIGINT) AS unique_values, coalesce(o.v, '') AS top_value,
  CAST(coalesce(o.n, 0) AS BIGINT) AS top_count
FROM s LEFT JOIN o ON o.col = s.col AND rn = 1""")
def category_summary(spark, sf):
    return profile.category_summary(schools(spark, sf), CATEGORICAL, "row_id")


_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


@query("profile_orders", f"""
WITH fx AS (SELECT * FROM orders),
l AS ({longform('fx', _ORDER_COLS, lambda c: d.norm(f'CAST({c} AS VARCHAR)'), 'o_orderkey AS rid')}),
g AS (SELECT col, v, count(*) AS n, min(rid) AS f FROM l GROUP BY 1, 2),
o AS (SELECT *, row_number() OVER (PARTITION BY col ORDER BY n DESC, f) AS rn FROM g WHERE v <> '')
SELECT g.col AS "column", 'texto' AS tipo_dato_detectado, count(*) AS valores_unicos,
  CAST(sum(g.n) AS BIGINT) AS valores_no_vacios, any_value(o.v) AS valor_mas_frecuente,
  any_value(o.n) AS frecuencia_top
FROM g JOIN o ON o.col = g.col AND rn = 1 WHERE g.v <> '' GROUP BY g.col""")
def profile_orders(spark, sf):
    orders = table(spark, sf, "orders")
    cols = orders.select(F.col("o_orderkey").alias("rid"), *[F.col(c).cast("string") for c in _ORDER_COLS])
    return profile.profile_columns(cols, _ORDER_COLS, "rid", r.logical_type)


@query("missing_report", f"""
WITH fx AS ({FX3}), l AS ({longform('fx', COLS, d.norm)})
SELECT col AS "column", count(*) FILTER (WHERE v = '') AS missing_count,
  round(100.0::DOUBLE * count(*) FILTER (WHERE v = '') / count(*), 2) AS missing_pct,
  count(*) FILTER (WHERE v <> '') AS non_missing_count
FROM l GROUP BY col ORDER BY 2 DESC, 1""")
def missing_report(spark, sf):
    return profile.missing_report(schools(spark, sf), COLS)


@query("value_counts", f"SELECT {d.norm('o_orderpriority')} AS value, count(*) AS n FROM orders GROUP BY 1")
def value_counts(spark, sf):
    return profile.value_counts(table(spark, sf, "orders"), "o_orderpriority")


@query("repeated_ids", """
SELECT l_orderkey, count(*) AS repeticiones FROM lineitem GROUP BY 1 HAVING count(*) > 1 ORDER BY 1""")
def repeated_ids(spark, sf):
    return profile.repeated_ids(table(spark, sf, "lineitem"), "l_orderkey")


@query("exact_dups", """
SELECT doc_id, count(*) OVER (PARTITION BY text, lang) > 1 AS duplicated,
  row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) > 1 AS seen_before FROM documents""")
def exact_dups(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    out = duplicates.flag_duplicates(docs, ["text", "lang"], "doc_id")
    return out.select("doc_id", "duplicated", "seen_before")


@query("exact_dup_counts", f"""
WITH g AS (SELECT count(*) AS n FROM ({FX3}) GROUP BY {', '.join(COLS)}),
t AS (SELECT count(*) AS n FROM documents GROUP BY text)
SELECT 'schools' AS source, CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS members,
  CAST(sum(n - 1) AS BIGINT) AS repeats FROM g
UNION ALL SELECT 'documents', CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT),
  CAST(sum(n - 1) AS BIGINT) FROM t""")
def exact_dup_counts(spark, sf):
    a = duplicates.count_duplicates(schools(spark, sf), COLS)
    b = duplicates.count_duplicates(table(spark, sf, "documents"), ["text"])
    return a.select(F.lit("schools").alias("source"), "*").unionByName(
        b.select(F.lit("documents").alias("source"), "*")
    )


@query("duplicate_summary", f"""
WITH fx AS ({FX3}), g AS (SELECT CODIGO, count(*) AS n FROM fx GROUP BY {', '.join(COLS)}),
k AS (SELECT CODIGO, count(*) AS n FROM fx WHERE {d.norm('CODIGO')} <> '' GROUP BY 1)
SELECT 'duplicados exactos' AS tipo, CAST(sum(n - 1) AS BIGINT) AS cantidad FROM g
UNION ALL SELECT 'CODIGO repetido', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM k
UNION ALL SELECT 'CODIGO invalido', count(*) FROM fx WHERE NOT regexp_matches(CODIGO, '{d.CODE}')""")
def duplicate_summary(spark, sf):
    return profile.duplicate_summary(schools(spark, sf), COLS, "CODIGO")


@query("placeholder_rows", f"""
WITH fx AS ({FX1}), l AS ({longform('fx', ['director', 'supervisor'], lambda c: c)})
SELECT row_id, col AS "column", v AS value FROM l WHERE upper({d.norm('v')}) IN {d.DIAG}""")
def placeholder_rows(spark, sf):
    return profile.placeholder_rows(fixture(spark, sf, DIRTY_TEXT), ["director", "supervisor"], "row_id")


@query("placeholder_summary", f"""
WITH fx AS ({FX1}), l AS ({longform('fx', ['name', 'address', 'director', 'supervisor'], lambda c: c)})
SELECT col AS "column", count(*) FILTER (WHERE upper({d.norm('v')}) IN {d.DIAG}) AS placeholder_rows
FROM l GROUP BY 1""")
def placeholder_summary(spark, sf):
    return profile.placeholder_summary(
        fixture(spark, sf, DIRTY_TEXT), ["name", "address", "director", "supervisor"]
    )


@query("domain_unexpected", f"""
WITH fx AS ({FX3})
SELECT DISTINCT 'SECTOR' AS col, upper({d.norm('SECTOR')}) AS value FROM fx
WHERE {d.norm('SECTOR')} <> '' AND upper({d.norm('SECTOR')}) NOT IN ('OFICIAL','PRIVADO','MUNICIPAL','COOPERATIVA')
UNION ALL
SELECT DISTINCT 'o_orderstatus', upper({d.norm('o_orderstatus')}) FROM orders
WHERE upper({d.norm('o_orderstatus')}) NOT IN ('O', 'F')""")
def domain_unexpected(spark, sf):
    df, orders = schools(spark, sf), table(spark, sf, "orders")
    a = profile.unexpected_values(df, "SECTOR", profile.value_list(df, r.DOMAINS["SECTOR"]))
    b = profile.unexpected_values(orders, "o_orderstatus", profile.value_list(df, ["O", "F"]))
    return a.select(F.lit("SECTOR").alias("col"), "value").unionByName(
        b.select(F.lit("o_orderstatus").alias("col"), "value")
    )


@query("catalog_validation", f"""
WITH fx AS ({FX3}), reg AS (SELECT r_name AS value FROM region),
checks AS (SELECT * FROM (VALUES ('NIVEL', 'DIVERSIFICADO'), ('AREA', 'RURAL, URBANA')) t(col, expected)
  UNION ALL SELECT c, (SELECT count(*) FROM reg) || ' departamentos locales'
  FROM (VALUES ('DEPARTAMENTO'), ('DEPARTAMENTAL')) t(c)),
known AS (SELECT * FROM (VALUES ('NIVEL', 'DIVERSIFICADO'), ('AREA', 'RURAL'), ('AREA', 'URBANA')) t(col, value)
  UNION ALL SELECT c, value FROM reg, (VALUES ('DEPARTAMENTO'), ('DEPARTAMENTAL')) t(c)),
l AS (SELECT DISTINCT col, upper(v) AS v FROM ({longform('fx', ['NIVEL', 'AREA', 'DEPARTAMENTO', 'DEPARTAMENTAL'], d.norm)})),
bad AS (SELECT l.col, v FROM l LEFT JOIN known k ON k.col = l.col AND k.value = v
  WHERE v <> '' AND k.value IS NULL)
SELECT checks.col AS "column", expected AS expected_values, coalesce(v, '') AS unexpected_value,
  count(v) OVER (PARTITION BY checks.col) AS unexpected_count
FROM checks LEFT JOIN bad ON bad.col = checks.col""")
def catalog_validation(spark, sf):
    regions = table(spark, sf, "region").select(text.normalize_upper(F.col("r_name")).alias("value"))
    return profile.catalog_validation(
        schools(spark, sf), r.DIAGNOSIS_DOMAINS, {"DEPARTAMENTO": regions, "DEPARTAMENTAL": regions}
    )


@query("preview_limit", f"""
SELECT *, greatest((SELECT count(*) FROM ({FX3})) - 5, 0) AS filas_adicionales,
  (SELECT count(*) FROM ({FX3})) AS filas, CAST(17 AS BIGINT) AS columnas
FROM ({FX3}) ORDER BY row_id LIMIT 5""")
def preview_limit(spark, sf):
    df = schools(spark, sf)
    shape = profile.shape(df.drop("row_id"))
    out = profile.preview(df, "row_id", 5)
    return out.withColumn("filas", shape.select("filas").scalar()).withColumn(
        "columnas", shape.select(F.col("columnas").cast("bigint")).scalar()
    )


_RULE_NAMES = [f.name for f in fields(r.Rule)]
_RULE_ROWS = ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in astuple(rule)) + ")" for rule in r.RULES)


@query("plan_table", f"""
WITH fx AS ({FX3}), l AS ({longform('fx', COLS, lambda c: c)}), texts({', '.join(_RULE_NAMES)}) AS (VALUES {_RULE_ROWS}),
n AS (SELECT col AS variable, count(*) FILTER (WHERE {d.norm('v')} = '') AS missing_count,
  count(*) FILTER (WHERE v <> {d.norm('v')}) AS untidy_count FROM l GROUP BY 1)
SELECT texts.*, missing_count, untidy_count FROM texts LEFT JOIN n USING (variable)""")
def plan_table(spark, sf):
    return r.plan_table(schools(spark, sf))


# ---- catalogues -----------------------------------------------------------

_PLACES = f"WITH fx AS ({FX3}), {d.catalog_ctes(CAT)}, {d.places_cte('fx', 'pl')}"


@query("catalog_dim", f"""{_PLACES}
SELECT dim.dk AS dept_key, dim.mk AS muni_key, dim.dc AS dept_canonical, dim.mc AS muni_canonical,
  count(pl.row_id) AS schools
FROM dim LEFT JOIN pl ON pl.dep = dim.dc AND pl.mun = dim.mc GROUP BY ALL""")
def catalog_dim(spark, sf):
    catalog = dim(spark, sf)
    placed = places.standardize_places(
        schools(spark, sf).select("DEPARTAMENTO", "MUNICIPIO"), catalog, RULES
    )
    counts = placed.groupBy(
        F.col("DEPARTAMENTO").alias("dept_canonical"), F.col("MUNICIPIO").alias("muni_canonical")
    ).agg(F.count("*").alias("schools"))
    out = catalog.join(counts, ["dept_canonical", "muni_canonical"], "left")
    return out.withColumn("schools", F.coalesce("schools", F.lit(0).cast("bigint")))


@query("canonical_lookup", f"{_PLACES} SELECT row_id, dep AS DEPARTAMENTO, mun AS MUNICIPIO FROM pl")
def canonical_lookup(spark, sf):
    df = schools(spark, sf).select("row_id", "DEPARTAMENTO", "MUNICIPIO")
    out = places.standardize_places(df, dim(spark, sf), RULES)
    return out.select("row_id", "DEPARTAMENTO", "MUNICIPIO")


@query("catalog_membership", f"""{_PLACES}
SELECT row_id, dep_ok AS DEPARTAMENTO_VALIDO, mun_ok AS MUNICIPIO_VALIDO FROM pl""")
def catalog_membership(spark, sf):
    df = schools(spark, sf).select("row_id", "DEPARTAMENTO", "MUNICIPIO")
    out = places.standardize_places(df, dim(spark, sf), RULES, "DEPARTAMENTO_VALIDO")
    return out.select("row_id", "DEPARTAMENTO_VALIDO", "MUNICIPIO_VALIDO")


@query("catalog_rejects", f"""{_PLACES}
SELECT DISTINCT {d.spaces('CODIGO')} AS CODIGO, dep AS DEPARTAMENTO, mun AS MUNICIPIO FROM pl WHERE NOT mun_ok""")
def catalog_rejects(spark, sf):
    df = schools(spark, sf).select(
        text.clean_spaces(F.col("CODIGO")).alias("CODIGO"), "DEPARTAMENTO", "MUNICIPIO"
    )
    placed = places.standardize_places(df, dim(spark, sf), RULES)
    return places.catalog_rejects(placed, ["CODIGO", "DEPARTAMENTO", "MUNICIPIO"])


@query("inconsistent_categories", f"""{_PLACES},
p AS (SELECT DISTINCT {d.spaces('DEPARTAMENTO')} AS dv, {d.spaces('MUNICIPIO')} AS mv, dep, mun FROM pl),
l AS ({longform('fx', SIMPLE, d.spaces)})
SELECT 'DEPARTAMENTO' AS columna, count(*) FILTER (WHERE dep <> upper(dv)) AS variantes
FROM (SELECT DISTINCT dv, dep FROM p)
UNION ALL SELECT 'MUNICIPIO', count(*) FILTER (WHERE mun <> upper(mv)) FROM p
UNION ALL SELECT col, count(DISTINCT v) FILTER (WHERE v <> upper(v)) FROM l GROUP BY col""")
def inconsistent_categories(spark, sf):
    return consistency.inconsistent_categories(schools(spark, sf), dim(spark, sf), SIMPLE, RULES)


@query("dependency_check", f"""{_PLACES},
c AS (SELECT dep = 'EUROPE' AS a, upper({d.spaces('DEPARTAMENTAL')}) IN ('EUROPE NORTE', 'EUROPE SUR') AS b FROM pl),
s AS (SELECT coalesce(bool_and(b) FILTER (WHERE a), true) AS i, coalesce(bool_or(b) FILTER (WHERE NOT a), false) AS o FROM c)
SELECT g AS grupo, i AS miembros_en_conjunto, o AS otros_en_conjunto, i AND NOT o AS consistente
FROM s, (VALUES ('EUROPE'), ('consistente')) t(g)""")
def dependency_check(spark, sf):
    df = schools(spark, sf).select(
        "DEPARTAMENTO", "MUNICIPIO", text.normalize_category(F.col("DEPARTAMENTAL")).alias("DEPARTAMENTAL")
    )
    return consistency.dependency_check(places.standardize_places(df, dim(spark, sf), RULES), REGIONAL)


#: Two groups: the one of the fixture, and one that no other row breaks.
_TWO = {"EUROPE": REGIONAL["EUROPE"], "ASIA": (["ÁSIA"], ["ASIA", "ÁSIA", "EUROPE NORTE"])}


def _group_sql(label: str, members: list[str], allowed: list[str]) -> str:
    a, b = (f"{c} IN ({', '.join(repr(x) for x in v)})" for c, v in (("dep", members), (f"upper({d.spaces('DEPARTAMENTAL')})", allowed)))
    return (f"SELECT '{label}' AS g, coalesce(bool_and({b}) FILTER (WHERE {a}), true) AS i, "
            f"coalesce(bool_or({b}) FILTER (WHERE NOT ({a})), false) AS o FROM pl")


@query("dependency_groups", f"""{_PLACES}, s AS ({' UNION ALL '.join(_group_sql(g, *v) for g, v in _TWO.items())})
SELECT g AS grupo, i AS miembros_en_conjunto, o AS otros_en_conjunto, i AND NOT o AS consistente FROM s
UNION ALL SELECT 'consistente', bool_and(i), bool_or(o), bool_and(i) AND NOT bool_or(o) FROM s""")
def dependency_groups(spark, sf):
    df = schools(spark, sf).select(
        "DEPARTAMENTO", "MUNICIPIO", text.normalize_category(F.col("DEPARTAMENTAL")).alias("DEPARTAMENTAL")
    )
    return consistency.dependency_check(places.standardize_places(df, dim(spark, sf), RULES), _TWO)


_KEYS = "DEPARTAMENTO, MUNICIPIO, ESTABLECIMIENTO"


_PARTS = f"""numbered AS (SELECT *, (row_number() OVER (PARTITION BY {_KEYS} ORDER BY row_id) - 1) // 10000 AS part,
  count(*) OVER (PARTITION BY {_KEYS}) AS members FROM ({FX3})),
parts AS (SELECT {_KEYS}, CAST(part AS BIGINT) AS part, string_agg(CODIGO, '; ' ORDER BY row_id) AS codigos
  FROM numbered WHERE members >= 2 GROUP BY {_KEYS}, 4)"""


@query("repeated_names", f"""
WITH {_PARTS}, sizes AS (SELECT {_KEYS},
  count(*) AS registros, count(DISTINCT DIRECCION) AS direcciones_distintas,
  count(DISTINCT STATUS) AS status_distintos, count(DISTINCT JORNADA) AS jornadas_distintas,
  count(DISTINCT PLAN) AS planes_distintos
FROM ({FX3}) GROUP BY {_KEYS} HAVING count(*) >= 2)
SELECT DEPARTAMENTO AS departamento, MUNICIPIO AS municipio, ESTABLECIMIENTO AS establecimiento, registros,
  direcciones_distintas, status_distintos, jornadas_distintas, planes_distintos, part AS parte, codigos
FROM sizes JOIN parts USING ({_KEYS})""")
def repeated_names(spark, sf):
    return repeated.repeated_names(schools(spark, sf), "row_id")


@query("repeated_codes", f"WITH {_PARTS} SELECT * FROM parts")
def repeated_codes(spark, sf):
    return repeated.repeated_codes(schools(spark, sf), "row_id")


# ---- expectations, on raw rows so that they fail; ``dq_clean`` runs them on the cleaned table ----


def joined(df):
    """Samples as text, for comparison."""
    return df.withColumn("sample", F.array_join("sample", " | "))


def dq_values(rule: str, col: str, values: str) -> str:
    """The result row of one rule, from a query of the failing values (v, n)."""
    return f"""SELECT '{rule}' AS rule, '{col}' AS "column", CAST(coalesce(sum(n), 0) AS BIGINT) AS failures,
  array_to_string((list_sort(list(v) FILTER (v IS NOT NULL)))[1:{ex.SAMPLE}], ' | ') AS sample FROM ({values})"""


def dq_sql(rule: str, col: str, failed: str, value: str, src: str = "fx") -> str:
    return dq_values(rule, col, f"SELECT {value} AS v, count(*) AS n FROM {src} WHERE {failed} GROUP BY 1")


def dq_union(parts: list[str]) -> str:
    """Empty samples as ''."""
    rows = " UNION ALL ".join(f"({p})" for p in parts)
    return f"""SELECT rule, "column", failures, coalesce(sample, '') AS sample FROM ({rows})"""


def dq_single(rule: str, col: str, failures: str, src: str) -> str:
    return f"""SELECT '{rule}' AS rule, '{col}' AS "column", CAST({failures} AS BIGINT) AS failures, CAST(NULL AS VARCHAR) AS sample FROM {src}"""


def dq_columns(cols: list[str]) -> str:
    return f"SELECT 'column_present', c, 0, NULL FROM (SELECT unnest({cols!r}) AS c)"


def dq_dups(src: str) -> str:
    return dq_single("exact_duplicates", "*", "coalesce(sum(CASE WHEN n > 1 THEN n END), 0)", f"(SELECT count(*) AS n FROM {src} GROUP BY {', '.join(COLS)})")


def dq_case(src: str) -> list[str]:
    return [
        dq_values("case_variants", c, f"SELECT min({c}) AS v, count(DISTINCT {c}) - 1 AS n FROM {src} WHERE {c} IS NOT NULL "
                  f"GROUP BY upper({c}) HAVING count(DISTINCT {c}) > 1") for c in _CASE
    ]


def dq_parts(col: str, src: str) -> str:
    parts = f"SELECT {d.strip('x')} AS x FROM (SELECT unnest(string_split({col}, ';')) AS x FROM {src})"
    return dq_sql("multi_value", col, "x <> '' AND NOT regexp_full_match(x, '[0-9]{7,8}')", "x", f"({parts})")


_FX = f"WITH fx AS ({FX3}) "
_EDGE = [c for c in COLS if c != "TELEFONO"]
_CASE = ["DEPARTAMENTO", "NIVEL", "SECTOR", "AREA", "STATUS", "MODALIDAD", "JORNADA", "PLAN"]


@query("dq_structure", _FX + dq_union([dq_single("not_empty", "*", "count(*) = 0", "fx"), dq_columns(COLS)]))
def dq_structure(spark, sf):
    df = schools(spark, sf)
    return joined(ex.expect_not_empty(df).unionByName(ex.expect_columns(df, COLS)))


@query("dq_exact_dups", _FX + dq_union([dq_dups("fx")]))
def dq_exact_dups(spark, sf):
    return joined(ex.expect_no_duplicates(schools(spark, sf), COLS))


@query("dq_unique", _FX + dq_union([dq_values("unique", "CODIGO", "SELECT CODIGO AS v, count(*) - 1 AS n FROM fx GROUP BY 1 HAVING count(*) > 1")]))
def dq_unique(spark, sf):
    return joined(ex.expect_unique(schools(spark, sf), "CODIGO"))


@query("dq_edge_spaces", _FX + dq_union([dq_sql("edge_spaces", c, f"{c} <> {d.strip(c)}", c) for c in _EDGE]))
def dq_edge_spaces(spark, sf):
    return joined(ex.check(schools(spark, sf), ex.no_edge_spaces(_EDGE)))


def dq_domain(c: str, values: list[str], src: str = "fx") -> str:
    return dq_sql("domain", c, f"{c} NOT IN ({', '.join(repr(x) for x in values)})", c, src)


@query("dq_domains", _FX + dq_union([dq_domain(c, v) for c, v in r.DOMAINS.items()]))
def dq_domains(spark, sf):
    return joined(ex.check(schools(spark, sf), ex.in_domain(r.DOMAINS)))


@query("dq_pattern", _FX + dq_union([dq_sql("pattern", "CODIGO", f"NOT regexp_matches(CODIGO, '{d.CODE}')", "CODIGO")]))
def dq_pattern(spark, sf):
    return joined(ex.check(schools(spark, sf), [ex.has_pattern("CODIGO")]))


@query("dq_not_null", f"WITH fx AS (SELECT nullif({d.spaces('DISTRITO')}, '') AS DISTRITO, CODIGO FROM ({FX3})) "
       + dq_union([dq_sql("not_null", c, f"{c} IS NULL", "CAST(NULL AS VARCHAR)") for c in ("CODIGO", "DISTRITO")]))
def dq_not_null(spark, sf):
    from tamiz.functions.codes import district_value

    df = schools(spark, sf).select("CODIGO", district_value(F.col("DISTRITO")).alias("DISTRITO"))
    return joined(ex.check(df, [ex.not_null("CODIGO"), ex.not_null("DISTRITO")]))


@query("dq_referential", _FX + dq_union([dq_sql(
    "referential", "DEPARTAMENTO", "DEPARTAMENTO NOT IN (SELECT r_name FROM region)", "DEPARTAMENTO")]))
def dq_referential(spark, sf):
    return joined(ex.expect_referential(schools(spark, sf), "DEPARTAMENTO", table(spark, sf, "region"), "r_name"))


# Raw cells hold no ';': the separators they have stand for it.
_SEMI = f"WITH fx AS (SELECT row_id, translate(TELEFONO, ',/-', ';;;') AS TELEFONO FROM ({FX3})) "


def _separated(spark, sf):
    return schools(spark, sf).select("row_id", F.translate("TELEFONO", ",/-", ";;;").alias("TELEFONO"))


@query("dq_multi_value", _SEMI + dq_union([dq_parts("TELEFONO", "fx")]))
def dq_multi_value(spark, sf):
    return joined(ex.expect_phone_parts(_separated(spark, sf), "TELEFONO"))


@query("dq_first_errors", f"""{_SEMI}
SELECT row_id, CAST(pos AS BIGINT) AS pos, part FROM (SELECT row_id, pos - 1 AS pos, {d.strip('parts[pos]')} AS part FROM (
  SELECT row_id, string_split(TELEFONO, ';') AS parts, unnest(range(1, len(string_split(TELEFONO, ';')) + 1)) AS pos FROM fx))
WHERE part <> '' AND NOT regexp_full_match(part, '[0-9]{{7,8}}') ORDER BY row_id, pos LIMIT 10""")
def dq_first_errors(spark, sf):
    out = ex.first_phone_errors(_separated(spark, sf), "TELEFONO", "row_id", 10)
    return out.withColumn("pos", F.col("pos").cast("bigint"))


@query("dq_case_variants", _FX + dq_union(dq_case("fx")))
def dq_case_variants(spark, sf):
    return joined(ex.expect_no_case_variants(schools(spark, sf), _CASE))


@query("dq_types", _FX + dq_union(["SELECT 'text_type' AS rule, 'CODIGO' AS \"column\", 0 AS failures, NULL AS sample",
       "SELECT 'text_type', 'row_id', 1, 'bigint'",
       dq_sql("integer", "TELEFONO", "TELEFONO <> '' AND NOT regexp_full_match(TELEFONO, '[0-9]+')", "TELEFONO")]))
def dq_types(spark, sf):
    df = schools(spark, sf).withColumn("TELEFONO", F.nullif(F.col("TELEFONO"), F.lit("")))
    text = ex.expect_text(df, "CODIGO").unionByName(ex.expect_text(df.withColumn("row_id", F.col("row_id").cast("bigint")), "row_id"))
    return joined(text.unionByName(ex.check(df, [ex.integer_text("TELEFONO")])))
