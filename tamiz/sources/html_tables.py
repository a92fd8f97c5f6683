"""Tables inside HTML files (often saved as ``.xls``) as records.

Everything stays inside one row per document until the records are exploded,
so no step shuffles. Markup is read as browsers do: an opening ``<td>`` or
``<tr>`` ends the open one, and character references need no semicolon where
HTML allows that.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.codes import CODE_PATTERN
from ..functions.text import let, normalize_text

SCRIPT_BLOCK = r"(?is)<script\b.*?</script>"
COMMENT = r"(?s)<!--.*?-->"
# Row and cell tags are put between two characters that no text may hold.
TABLE_TAG = r"(?i)<(/?t(?:r|d|able))(?![a-z0-9])[^>]*>"
OPEN, CLOSE = "\ufdd0", "\ufdd1"
ROW_EDGE = f"(?i){OPEN}/?t(?:r|able){CLOSE}"
CELL_START = f"(?i){OPEN}td{CLOSE}"
CELL_END = f"(?is){OPEN}/td{CLOSE}.*"
TAG = r"(?s)</?[A-Za-z!?][^>]*>"
REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
# Names that need no semicolon, the longest first.
BARE_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
# Bytes 0x80 to 0x9F as Windows-1252 has them: what a number in that range means.
C1 = "".join(chr(b) for b in range(0x80, 0xA0))
WINDOWS_C1 = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))

# The header row's first cell, and a cell it must contain.
HEADER_FIRST = "CODIGO"
HEADER_MEMBER = "ESTABLECIMIENTO"


def _character(code: Column) -> Column:
    """The character a number stands for; NULL means a number beyond any range."""
    nothing = (
        code.between(1, 8) | code.between(0x0E, 0x1F) | code.isin(0x0B, 0x7F) | code.between(0xFDD0, 0xFDEF)
        | ((code % 0x10000) >= 0xFFFE)
    )
    # A code point as four big-endian bytes is the character in UTF-32.
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    known = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    return F.when(known & nothing, F.lit("")).when(known, F.translate(plain, C1, WINDOWS_C1)).otherwise(F.lit("\ufffd"))


def unescape_html(col: Column) -> Column:
    """Resolve character references as HTML 5 does: all names, those that need no ``;`` also as the start of a word, and numbers."""
    common = sorted(html5.items(), key=lambda e: (e[0].rstrip(";") not in BARE_NAMES, e[0]))
    names = F.from_json(F.lit(json.dumps(dict(common))), "map<string, string>")
    bare = f"^({'|'.join(BARE_NAMES)})"

    def tail(piece: Column, used: Column) -> Column:
        return F.substring(piece, F.length(used) + 1, F.length(piece))

    def named(piece: Column, ref: Column) -> Column:
        whole = F.concat(F.try_element_at(names, ref), tail(piece, ref))
        start = let(
            F.regexp_extract(ref, bare, 1),
            lambda name: F.when(name != "", F.concat(F.try_element_at(names, name), tail(piece, name))),
        )
        return F.coalesce(whole, start)

    def numbered(piece: Column, ref: Column) -> Column:
        digits = F.regexp_extract(ref, "^#[xX]?0*([0-9a-fA-F]{1,12})", 1)
        code = F.when(ref.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).try_cast("bigint")
        return F.concat(let(F.coalesce(code, F.lit(0)), _character), tail(piece, ref))

    def decoded(piece: Column) -> Column:
        return let(
            F.regexp_extract(piece, REFERENCE, 1),
            lambda ref: F.coalesce(
                F.when(ref.startswith("#"), numbered(piece, ref)).when(ref != "", named(piece, ref)),
                F.concat(F.lit("&"), piece),
            ),
        )

    # Every piece but the first follows an ampersand.
    pieces = F.transform(
        F.split(col, "&"), lambda piece, i: F.when(i == 0, piece).otherwise(decoded(piece))
    )
    return F.when(F.instr(col, "&") == 0, col).otherwise(F.array_join(pieces, ""))


def read_html_files(spark: SparkSession, path: str, charset: str = "ISO-8859-1") -> DataFrame:
    """(source, path, modificationTime, length, html): one row per file, decoded."""
    files = spark.read.format("binaryFile").load(path)
    return decode_files(files, charset)


def decode_files(files: DataFrame, charset: str = "ISO-8859-1") -> DataFrame:
    return files.select(
        source_name(F.col("path")).alias("source"),
        "path", "modificationTime", "length",
        F.decode("content", charset).alias("html"),
    )


def source_name(path: Column) -> Column:
    """File name without folder and extension."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def table_rows(html: Column, unclosed: str = "end") -> Column:
    """array<array<string>>: the cells of each row that has any, whitespace collapsed.

    ``unclosed`` says what happens to a cell or row that is still open where the
    next one starts: ``end`` ends it there, ``drop`` leaves out the cell, and
    all cells of the row. Text outside cells is not read.
    """
    if unclosed not in ("end", "drop"):
        raise ValueError(f"unclosed is 'end' or 'drop', not {unclosed!r}")
    text = F.regexp_replace(F.regexp_replace(html, SCRIPT_BLOCK, ""), COMMENT, "")
    marked = F.regexp_replace(F.translate(text, OPEN + CLOSE, ""), TABLE_TAG, f"{OPEN}$1{CLOSE}")

    def clean(cell: Column) -> Column:
        return normalize_text(unescape_html(F.regexp_replace(cell, TAG, "")))

    def cells(row: Column) -> Column:
        parts = F.slice(F.split(row, CELL_START), 2, 1 << 30)
        if unclosed == "drop":
            parts = F.filter(parts, lambda p: p.rlike(CELL_END))
        return F.transform(parts, lambda p: clean(F.regexp_replace(p, CELL_END, "")))

    if unclosed == "drop":
        starts = F.split(marked, f"(?i){OPEN}tr{CLOSE}")
        ended = f"(?is){OPEN}/tr{CLOSE}.*"
        rows = F.transform(F.filter(starts, lambda r: r.rlike(ended)), lambda r: cells(F.regexp_replace(r, ended, "")))
    else:
        rows = F.transform(F.split(marked, ROW_EDGE), cells)
    return F.filter(rows, lambda r: F.size(r) > 0)


def header_index(rows: Column) -> Column:
    """0-based position of the header row, NULL without one."""
    is_header = F.transform(
        rows,
        lambda r: (F.upper(F.get(r, F.lit(0))) == HEADER_FIRST)
        & F.exists(r, lambda c: F.upper(c) == HEADER_MEMBER),
    )
    return F.nullif(F.array_position(is_header, True), F.lit(0)) - 1


def html_table_rows(docs: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """(keys, pos, cells): one row per table row."""
    # The outer form, with a filter behind it, parses each document once; for the
    # plain form the optimizer adds a test of the array and parses it twice.
    rows = F.posexplode_outer(table_rows(F.col(html))).alias("pos", "cells")
    return docs.select(*keys, rows).filter("pos IS NOT NULL")


def html_header_index(docs: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """(keys, header): NULL marks documents to reject."""
    return docs.withColumn("_rows", table_rows(F.col(html))).select(
        *keys, header_index(F.col("_rows")).alias("header")
    )


def parsed_records(
    docs: DataFrame, keys: list[str], columns: list[str], html: str = "html",
    pattern: str = CODE_PATTERN, unclosed: str = "end",
) -> DataFrame:
    """(keys, header, rows, filas, nth, pos, columns): the data rows after the header, cut or padded to ``columns``.

    A document without data rows is one row whose ``pos`` is NULL, so nothing is
    lost on the way; ``header`` is NULL for a document to reject, ``rows``
    counts its table rows and ``filas`` its data rows, which ``nth`` numbers from 0
    (see :func:`documents`). Each document is parsed once.
    """
    width = len(columns)
    parsed = docs.withColumn("_rows", table_rows(F.col(html), unclosed)).withColumn(
        "_header", header_index(F.col("_rows"))
    )
    data = F.filter(
        F.transform(F.col("_rows"), lambda r, i: F.struct(i.alias("pos"), r.alias("cells"))),
        lambda r: (r["pos"] > F.col("_header")) & F.get(r["cells"], F.lit(0)).rlike(pattern),
    )
    rows = parsed.withColumn("_data", data).select(
        *keys, F.col("_header").alias("header"), F.size("_rows").alias("rows"),
        F.when(F.col("_data").isNull(), 0).otherwise(F.size("_data")).alias("filas"), F.posexplode_outer("_data").alias("nth", "_r"),
    )
    padded = F.slice(F.concat(F.col("_r.cells"), F.array_repeat(F.lit(""), width)), 1, width)
    document = [*keys, "header", "rows", "filas", "nth"]
    rows = rows.select(*document, F.col("_r.pos").alias("pos"), padded.alias("_cells"))
    return rows.select(*document, "pos", *[F.get("_cells", F.lit(i)).alias(c) for i, c in enumerate(columns)])


def documents(parsed: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rows, filas, header): one row per document of :func:`parsed_records`; nothing is shuffled or counted for it."""
    first = parsed.filter(F.coalesce("nth", F.lit(0)) == 0)
    return first.select(*keys, *[F.col(c).cast("bigint").alias(c) for c in ("rows", "filas", "header")])


def html_records(
    docs: DataFrame, keys: list[str], columns: list[str], html: str = "html",
    pattern: str = CODE_PATTERN, strict: bool = True, unclosed: str = "end",
) -> DataFrame:
    """Data rows after the header, cut or padded to ``columns``, with their position.

    With ``strict`` a document without header row is an error; otherwise it
    yields no records (:func:`rejects` lists such documents).
    """
    rows = parsed_records(docs, keys, columns, html, pattern, unclosed)
    known = F.col("pos").isNotNull()
    if strict:
        known = F.when(F.col("header").isNull(), F.raise_error(F.lit("no header row in document")).cast("boolean")).otherwise(known)
    return rows.filter(known).drop("header", "rows", "filas", "nth")


# Why a document is rejected.
NO_TABLE = "no table row"
NO_HEADER = "no header row"


def rejects(docs: DataFrame, keys: list[str], html: str = "html", unclosed: str = "end") -> DataFrame:
    """(keys, reason, rows, first): the documents without header row, how many table rows they have, and the first one."""
    parsed = docs.select(*keys, table_rows(F.col(html), unclosed).alias("_rows"))
    parsed = parsed.withColumn("_header", header_index(F.col("_rows"))).filter("_header IS NULL")
    return parsed.select(
        *keys,
        F.when(F.coalesce(F.size("_rows"), F.lit(0)) == 0, F.lit(NO_TABLE)).otherwise(F.lit(NO_HEADER)).alias("reason"),
        F.size("_rows").cast("bigint").alias("rows"),
        F.array_join(F.get("_rows", F.lit(0)), " | ").alias("first"),
    )
