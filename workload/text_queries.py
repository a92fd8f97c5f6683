"""Scalar text, codes and phones."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamiz.functions import codes, phones, text
from tamiz.operators import profile
from tamiz.operators.unify import unify_variants, variant_map
from tamiz.plans import cleaning

from . import duck as d
from .fixtures import DIRTY_TEXT, PHONES, SCHOOLS, duck, fixture, table
from .registry import query

TEXT_COLS = ["name", "address", "supervisor", "director"]
FX1, FX2, FX3 = duck(DIRTY_TEXT), duck(PHONES), duck(SCHOOLS)


def _project(fn, expr):
    """(query function, oracle) of one expression on all four dirty text columns."""

    def run(spark, sf):
        df = fixture(spark, sf, DIRTY_TEXT)
        return df.select("row_id", *[fn(F.col(c)).alias(c) for c in TEXT_COLS])

    cols = ", ".join(f"{expr(c)} AS {c}" for c in TEXT_COLS)
    return run, f"SELECT row_id, {cols} FROM ({FX1})"


for _name, _fn, _expr in [
    ("clean_spaces", text.clean_spaces, d.spaces),
    ("strip_wrapping_quotes", text.strip_wrapping_quotes, d.quotes),
    ("strip_edge_punct", text.strip_edge_punct, d.punct),
    ("clean_text", text.clean_text, d.clean_text),
    ("is_placeholder", text.is_placeholder, d.placeholder),
]:
    _run, _sql = _project(_fn, _expr)
    query(_name, _sql)(_run)


@query("normalize_text", f"""
SELECT doc_id AS id, {d.norm('text')} AS value FROM documents
UNION ALL SELECT row_id, {d.norm('name')} FROM ({FX1})""")
def normalize_text(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    names = fixture(spark, sf, DIRTY_TEXT).select("row_id", "name")
    return docs.union(names).select("id", text.normalize_text(F.col("text")).alias("value"))


@query("fix_grave_accents", f"SELECT doc_id, {d.grave('text')} AS text FROM documents")
def fix_grave_accents(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", text.fix_grave_accents(F.col("text")).alias("text"))


@query("fold_key", f"""
SELECT doc_id AS id, {d.fold_key('text')} AS value FROM documents
UNION ALL SELECT row_id, {d.fold_key(d.spaces('name'))} FROM ({FX1})""")
def fold_key(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    names = fixture(spark, sf, DIRTY_TEXT).select("row_id", text.clean_spaces(F.col("name")))
    return docs.union(names).select("id", text.fold_key(F.col("text")).alias("value"))


@query("null_mask", f"""
SELECT row_id, CASE WHEN NOT {d.placeholder('director')} THEN director END AS director FROM ({FX1})""")
def null_mask(spark, sf):
    df = fixture(spark, sf, DIRTY_TEXT)
    col = F.col("director")
    return df.select("row_id", text.null_where(col, text.is_placeholder(col)).alias("director"))


def _unified_ctes() -> str:
    parts = [f"t AS (SELECT row_id, {', '.join(f'{d.clean_text(c)} AS {c}' for c in TEXT_COLS)} FROM ({FX1}))"]
    parts += [f"u_{c} AS ({d.unified('t', c)})" for c in TEXT_COLS]
    return ", ".join(parts)


_FREE = ["address", "supervisor", "director"]


@query("clean_free_text", f"""
WITH {_unified_ctes()}
SELECT t.row_id, {', '.join(f"CASE WHEN NOT {d.placeholder(f'u_{c}.canonical')} THEN u_{c}.canonical END AS {c}" for c in _FREE)}
FROM t {' '.join(f'JOIN u_{c} ON u_{c}.variant = t.{c}' for c in _FREE)}""")
def clean_free_text(spark, sf):
    df = fixture(spark, sf, DIRTY_TEXT).select("row_id", *_FREE)
    for col in _FREE:
        df = cleaning.clean_free_text(df, col)
    return df.select("row_id", *_FREE)


@query("clean_name", f"""
WITH {_unified_ctes()}
SELECT t.row_id, nullif(canonical, '') AS name FROM t JOIN u_name ON variant = name""")
def clean_name(spark, sf):
    df = fixture(spark, sf, DIRTY_TEXT).select("row_id", "name")
    return cleaning.clean_name(df, "name")


@query("unify_variants", f"""
WITH {_unified_ctes()},
n AS ({' UNION ALL '.join(f"SELECT '{c}' AS col, * FROM u_{c}" for c in TEXT_COLS)})
SELECT col, variant, canonical FROM n WHERE variant <> canonical
UNION ALL
SELECT 'rows', canonical, CAST(count(*) AS VARCHAR) FROM t JOIN u_name ON variant = name GROUP BY canonical""")
def unify(spark, sf):
    df = fixture(spark, sf, DIRTY_TEXT)
    df = df.select(*[text.clean_text(F.col(c)).alias(c) for c in TEXT_COLS])
    maps = [variant_map(df, c).select(F.lit(c).alias("col"), "variant", "canonical") for c in TEXT_COLS]
    rows = unify_variants(df.select("name"), "name").groupBy(F.col("name").alias("variant")).agg(
        F.count("*").cast("string").alias("canonical")
    )
    maps.append(rows.select(F.lit("rows").alias("col"), "variant", "canonical"))
    return profile.stack_reports(maps)


@query("classify_format", f"""
SELECT row_id, nullif({d.spaces('DISTRITO')}, '') AS value, {d.district('DISTRITO')} AS format,
  {d.district('DISTRITO')} IN ('detallado', 'corto') AS valid FROM ({FX3})""")
def classify_format(spark, sf):
    df = fixture(spark, sf, SCHOOLS)
    col = F.col("DISTRITO")
    kind = codes.classify_format(col)
    return df.select(
        "row_id", codes.district_value(col).alias("value"), kind.alias("format"),
        kind.isin(codes.VALID_CLASSES).alias("valid"),
    )


@query("code_valid", f"""
SELECT row_id, {d.spaces('CODIGO')} AS code, regexp_matches({d.spaces('CODIGO')}, '{d.CODE}') AS valid
FROM ({FX3})""")
def code_valid(spark, sf):
    code = text.clean_spaces(F.col("CODIGO"))
    return fixture(spark, sf, SCHOOLS).select(
        "row_id", code.alias("code"), codes.matches_code(code).alias("valid")
    )


@query("invalid_codes", f"""
SELECT row_id, CODIGO, DISTRITO, DEPARTAMENTO, MUNICIPIO FROM (
  SELECT row_id, {', '.join(f'{d.strip(c)} AS {c}' for c in d.COLUMNS[:4])} FROM ({FX3}))
WHERE NOT regexp_matches(CODIGO, '{d.CODE}')""")
def invalid_codes(spark, sf):
    df = fixture(spark, sf, SCHOOLS)
    cols = ["CODIGO", "DISTRITO", "DEPARTAMENTO", "MUNICIPIO"]
    stripped = df.select("row_id", *[text.strip(F.col(c)).alias(c) for c in cols])
    return profile.invalid_rows(stripped, "CODIGO", ["row_id", *cols])


@query("normalize_category", f"""
SELECT row_id, {', '.join(f'upper({d.spaces(c)}) AS {c}' for c in d.SIMPLE)} FROM ({FX3})""")
def normalize_category(spark, sf):
    df = fixture(spark, sf, SCHOOLS)
    return df.select("row_id", *[text.normalize_category(F.col(c)).alias(c) for c in d.SIMPLE])


_PH = f"WITH fx AS ({FX2}), {d.phone_ctes('fx')}"


@query("phone_flags", f"""{_PH} SELECT row_id, body, has_fax, has_ext, has_range FROM ph_body""")
def phone_flags(spark, sf):
    df = fixture(spark, sf, PHONES).withColumn("m", phones.phone_markers(F.col("telefono")))
    return df.select("row_id", F.col("m.text").alias("body"), "m.has_fax", "m.has_ext", "m.has_range")


@query("phone_split", f"""{_PH}
SELECT row_id, CAST(len(tokens) AS BIGINT) AS n_tokens, array_to_string(tokens, '|') AS tokens,
  array_to_string(list_filter(tokens, lambda t: NOT regexp_full_match(t, '[0-9\\- ]+')), '|') AS rejected
FROM ph_tokens""")
def phone_split(spark, sf):
    df = fixture(spark, sf, PHONES).withColumn(
        "tokens", phones.split_tokens(phones.phone_markers(F.col("telefono"))["text"])
    )
    return df.select(
        "row_id",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.array_join("tokens", "|").alias("tokens"),
        F.array_join(F.filter("tokens", lambda t: ~t.rlike(phones.NUMBER_TOKEN)), "|").alias("rejected"),
    )


@query("phone_dash_expand", f"""{_PH}
SELECT row_id, array_to_string(list_transform(items, lambda i: i.v), '|') AS items FROM ph_items""")
def phone_dash_expand(spark, sf):
    df = fixture(spark, sf, PHONES).withColumn(
        "tokens", phones.split_tokens(phones.phone_markers(F.col("telefono"))["text"])
    )
    items = F.transform(phones.classify_items(F.col("tokens")), lambda i: i["v"])
    return df.select("row_id", F.array_join(items, "|").alias("items"))


@query("phone_clean", f"""{_PH}
SELECT row_id, original AS telefono_original, {d.PHONE_JOINED} AS telefono,
  CAST(len(numbers) AS BIGINT) AS cantidad, {d.PHONE_VALID} AS valido FROM ph_done""")
def phone_clean(spark, sf):
    df = phones.clean_phones(fixture(spark, sf, PHONES), "telefono")
    return df.select(
        "row_id", "telefono_original", "telefono",
        F.col("telefono_cantidad").cast("bigint").alias("cantidad"),
        F.col("telefono_valido").alias("valido"),
    )


@query("phone_observation", f"""{_PH} SELECT row_id, {d.PHONE_NOTE} AS observacion FROM ph_done""")
def phone_observation(spark, sf):
    df = phones.clean_phones(fixture(spark, sf, PHONES), "telefono")
    return df.select("row_id", F.col("telefono_observacion").alias("observacion"))


@query("phone_explode", f"""{_PH}
SELECT row_id, CAST(p AS BIGINT) AS pos, numbers[p + 1] AS number
FROM (SELECT row_id, numbers, unnest(range(len(numbers))) AS p FROM ph_done)""")
def phone_explode(spark, sf):
    out = phones.explode_phones(fixture(spark, sf, PHONES), "row_id", "telefono")
    return out.withColumn("pos", F.col("pos").cast("bigint"))


@query("phone_suspicious", f"""
SELECT * FROM (SELECT row_id, {d.norm('telefono')} AS telefono, CAST(length({d.norm('telefono')}) AS BIGINT) AS length,
  regexp_full_match({d.norm('telefono')}, '[0-9]+') AS has_digits_only FROM ({FX2}))
WHERE telefono <> '' AND (NOT has_digits_only OR length < 7 OR length > 12)""")
def phone_suspicious(spark, sf):
    out = phones.suspicious_phones(fixture(spark, sf, PHONES), "row_id", "telefono")
    return out.withColumn("length", F.col("length").cast("bigint"))
