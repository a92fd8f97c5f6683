"""DuckDB expressions that restate the transforms for the correctness check."""

from __future__ import annotations

from tamiz.plans.rules import COLUMNS, FREE_TEXT, SIMPLE_CATEGORIES  # noqa: F401

SP = (
    r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
SP_IN = SP[1:-1]
INVIS = r"[\x{A0}\x{200B}\x{200C}\x{200D}\x{2060}\x{FEFF}\x{9}]"
# The placeholder texts, restated for an oracle of its own.
MISSING = "('N/A','NA','N.A','NULL','NONE','SIN DATO','SIN DATOS','S/D','SD','SIN REGISTRO')"
DIAG = "('','-','--','---','----','SIN DATO','N/A','NA')"
CODE = r"^[0-9]{2}-[0-9]{2}-[0-9]{4}-[0-9]{2}$"

SIMPLE, TEXTS = SIMPLE_CATEGORIES, FREE_TEXT


def let(value: str, name: str, body: str) -> str:
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def strip(e: str) -> str:
    return f"regexp_replace({e}, '^{SP}+|{SP}+$', '', 'g')"


def norm(e: str) -> str:
    return f"regexp_replace({strip(f'coalesce({e}, {chr(39)*2})')}, '{SP}+', ' ', 'g')"


def spaces(e: str) -> str:
    return strip(
        f"regexp_replace(regexp_replace(coalesce({e}, ''), '{INVIS}', ' ', 'g'), ' {{2,}}', ' ', 'g')"
    )


def grave(e: str) -> str:
    return f"translate({e}, 'àèìòùÀÈÌÒÙ', 'áéíóúÁÉÍÓÚ')"


def quotes(e: str) -> str:
    inner = "substr(q, 2, length(q) - 2)"
    return let(
        e, "q",
        f"""CASE WHEN length(q) >= 2 AND q[1] = '"' AND q[-1] = '"' AND instr({inner}, '"') = 0 """
        f"THEN {strip(inner)} ELSE q END",
    )


def punct(e: str) -> str:
    return f"regexp_replace({e}, '^[,;:{SP_IN}]+|[,;:{SP_IN}]+$', '', 'g')"


def clean_text(e: str) -> str:
    return punct(quotes(grave(spaces(e))))


def placeholder(e: str) -> str:
    return let(
        strip(e), "t",
        "(t = '' OR regexp_full_match(t, '[-.,_]+') OR regexp_full_match(t, '[xX0]+') "
        f"OR upper(t) IN {MISSING})",
    )


def fold(e: str) -> str:
    """Accents off by the built-in function, then the special letters one by one."""
    out = f"strip_accents({e})"
    for a, b in (("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"), ("ø", "o"), ("Ø", "O"),
                 ("º", "o"), ("ª", "a"), ("—", "--"), ("…", "..."), ("«", "<<"), ("»", ">>")):
        out = f"replace({out}, '{a}', '{b}')"
    return f"translate({out}, '‘’“”–¿¡\u00a0\u200b', '''''\"\"-?! ')"


def fold_key(e: str) -> str:
    return f"upper({strip(fold(e))})"


def district(e: str) -> str:
    return let(
        spaces(e), "d",
        "CASE WHEN d = '' THEN 'vacio' "
        "WHEN regexp_full_match(d, '[0-9]{2}-[0-9]{2}-[0-9]{4}') THEN 'detallado' "
        "WHEN regexp_full_match(d, '[0-9]{2}-[0-9]{3}') THEN 'corto' "
        "WHEN regexp_full_match(d, '[0-9]{2}-') THEN 'incompleto' ELSE 'formato_no_reconocido' END",
    )


def unified(table: str, col: str) -> str:
    """(variant, canonical) of all values of ``col`` (already cleaned) in ``table``."""
    return f"""
SELECT v AS variant, first_value(v) OVER (PARTITION BY {fold('v')}
    ORDER BY length(regexp_replace(v, '[^ÁÉÍÓÚ]', '', 'g')) DESC, v COLLATE "C" DESC) AS canonical
FROM (SELECT DISTINCT {col} AS v FROM {table} WHERE {col} IS NOT NULL)"""


# Phone steps as CTEs: {src} supplies (row_id, telefono); the last one is ph_done.
def phone_ctes(src: str, id_col: str = "row_id", col: str = "telefono") -> str:
    dash = let(
        "list_filter(string_split(s, '-'), lambda p: p <> '')", "ps",
        "CASE WHEN len(ps) <= 1 THEN ps WHEN len(list_filter(ps, lambda p: length(p) < 6)) = 0 THEN ps "
        "WHEN len(ps) = 2 AND length(ps[1]) + length(ps[2]) IN (7, 8) AND length(ps[1]) IN (3, 4) "
        "THEN [ps[1] || ps[2]] ELSE list_transform(ps, lambda p, i: CASE WHEN i = 1 OR length(p) >= 6 "
        "THEN p ELSE left(ps[1], length(ps[1]) - length(p)) || p END) END",
    )
    return rf"""
ph_text AS (SELECT {id_col}, {col} AS original, {spaces(col)} AS txt FROM {src}),
ph_range AS (SELECT *, regexp_matches(txt, '(?i)\bAL\b') AS has_range FROM ph_text),
ph_fax AS (SELECT *, NOT has_range AND regexp_matches(txt, '(?i)\bFAX\b') AS has_fax FROM ph_range),
ph_ext0 AS (SELECT *, CASE WHEN has_fax THEN regexp_split_to_array(txt, '(?i)\bFAX\b')[1] ELSE txt END AS t1 FROM ph_fax),
ph_ext AS (SELECT *, NOT has_range AND regexp_matches(t1, '(?i)\bEST[XA]?\.?\b|\bEXT\.?\b') AS has_ext FROM ph_ext0),
ph_body AS (SELECT *, CASE WHEN has_range THEN '' ELSE {spaces(
    "CASE WHEN has_ext THEN regexp_split_to_array(t1, '(?i)" + chr(92) + "bEST[XA]?" + chr(92) + ".?" + chr(92)
    + "b|" + chr(92) + "bEXT" + chr(92) + ".?" + chr(92) + "b')[1] ELSE t1 END")} END AS body FROM ph_ext),
ph_tokens AS (SELECT *, list_filter(list_transform(
    regexp_split_to_array(body, '(?i)\s*(?:,|/|\bY\b)\s*'), lambda x: {strip('x')}), lambda x: x <> '') AS tokens FROM ph_body),
ph_items AS (SELECT *, flatten(list_transform(tokens, lambda t: CASE
    WHEN NOT regexp_full_match(t, '[0-9\- ]+') THEN [{{'v': t, 'ok': false}}]
    ELSE list_transform(flatten(list_transform(list_filter(string_split(t, ' '), lambda s: s <> ''),
        lambda s: {dash})), lambda n: {{'v': n, 'ok': length(n) IN (7, 8)}}) END)) AS items FROM ph_tokens),
ph_done AS (SELECT *,
    list_transform(list_filter(items, lambda i: i.ok), lambda i: i.v) AS numbers,
    list_transform(list_filter(items, lambda i: NOT i.ok), lambda i: i.v) AS bad FROM ph_items)"""


PHONE_JOINED = "CASE WHEN len(numbers) > 0 THEN array_to_string(numbers, '; ') END"
PHONE_VALID = (
    "(len(numbers) > 0 AND len(bad) = 0 AND NOT has_range "
    "AND len(list_filter(numbers, lambda n: length(n) <> 8)) = 0)"
)
PHONE_NOTE = f"""CASE WHEN {spaces('original')} = '' THEN 'vacio' ELSE coalesce(nullif(array_to_string(list_filter([
    CASE WHEN has_range THEN 'rango no expandido (revision manual)' END,
    CASE WHEN has_fax THEN 'incluye FAX' END,
    CASE WHEN has_ext THEN 'incluye extension' END,
    CASE WHEN len(bad) > 0 THEN 'longitud invalida: ' || array_to_string(bad, ', ') END,
    CASE WHEN len(list_filter(numbers, lambda n: length(n) = 7)) > 0 THEN 'formato antiguo de 7 digitos' END,
    CASE WHEN len(numbers) > 1 THEN len(numbers) || ' telefonos en una celda' END
  ], lambda x: x IS NOT NULL), '; '), ''), 'ok') END"""


def catalog_ctes(catalog: str) -> str:
    """dim (dk, mk, dc, mc) and deps (dk, dc) from a (department, municipality) SELECT."""
    return f"""
dim AS (SELECT {fold_key('department')} AS dk, {fold_key('municipality')} AS mk,
    max(upper(department)) AS dc, max(upper(municipality)) AS mc FROM ({catalog}) GROUP BY 1, 2),
deps AS (SELECT dk, max(dc) AS dc FROM dim GROUP BY 1)"""


def places_cte(src: str, out: str, zoned: str = "MIDDLE EAST") -> str:
    """Adds dep, mun, mun_ok, dep_ok to ``src`` (columns DEPARTAMENTO, MUNICIPIO)."""
    muni = f"upper({spaces('s.MUNICIPIO')})"
    return rf"""
{out}_k AS (SELECT s.*, {fold_key(spaces('s.DEPARTAMENTO'))} AS dkey, {muni} AS mtext,
    {fold_key(spaces('s.MUNICIPIO'))} AS mkey FROM {src} s),
{out} AS (SELECT k.*,
    CASE WHEN dkey = '{zoned}' THEN '{zoned}' ELSE coalesce(deps.dc, dkey) END AS dep,
    CASE WHEN dkey = '{zoned}' THEN mtext ELSE coalesce(dim.mc, mtext) END AS mun,
    CASE WHEN dkey = '{zoned}' THEN regexp_full_match(mtext, 'ZONA ([1-9]|1[0-9]|2[0-5])')
         ELSE dim.mc IS NOT NULL END AS mun_ok,
    {fold_key('k.DEPARTAMENTO')} = '{zoned}' OR {fold_key('k.DEPARTAMENTO')} IN (SELECT dk FROM deps) AS dep_ok
  FROM {out}_k k LEFT JOIN deps ON deps.dk = dkey
    LEFT JOIN dim ON dim.dk = dkey AND dim.mk = mkey)"""


def token_sort(e: str) -> str:
    return (
        f"array_to_string(list_sort(regexp_split_to_array({strip(e)}, '{SP}+')), ' ')"
    )


def pairs_ctes(src: str, name: str, block: list[str], row: str = "row_id") -> str:
    """pr (a, b, s): all row pairs within a block scored by a running LCS, 90 <= s, rounded < 100.

    The LCS is a recursive query over the characters of the first key: each
    step holds one row of the classic table as a list.
    """
    blocks = ", ".join(block)
    on = " AND ".join(f"x.{c} = y.{c}" for c in block)
    present = " AND ".join(f"{c} IS NOT NULL" for c in [*block, name])
    return f"""
keyed AS (SELECT {row} AS rid, {blocks}, {token_sort(name)} AS ky FROM {src} WHERE {present}),
cand AS (SELECT DISTINCT x.ky AS ka, y.ky AS kb FROM keyed x JOIN keyed y ON {on} AND x.ky < y.ky
    WHERE length(x.ky) > 0 AND length(y.ky) > 0
      AND 11 * least(length(x.ky), length(y.ky)) >= 9 * greatest(length(x.ky), length(y.ky))),
walk AS (
  SELECT ka, kb, 0 AS i, list_transform(range(length(kb) + 1), lambda z: 0) AS best FROM cand
  UNION ALL
  SELECT ka, kb, i + 1, list_transform(range(1, length(kb) + 2), lambda e: list_max(
      list_transform(range(1, e + 1), lambda j: CASE WHEN j > 1 AND kb[j - 1] = ka[i + 1]
        THEN best[j - 1] + 1 ELSE best[j] END))) FROM walk WHERE i < length(ka)),
scored AS (SELECT ka, kb, 200.0::DOUBLE * best[length(kb) + 1] / (length(ka) + length(kb)) AS sc
  FROM walk WHERE i = length(ka)),
near AS (SELECT *, round_even(sc, 1) AS s FROM scored WHERE sc >= 90),
pr AS (SELECT least(x.rid, y.rid) AS a, greatest(x.rid, y.rid) AS b, s FROM near
    JOIN keyed x ON x.ky = ka JOIN keyed y ON y.ky = kb AND {on} WHERE s < 100)"""
