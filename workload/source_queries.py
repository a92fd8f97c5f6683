"""HTML tables, pages, CSV, sinks and incremental ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamiz.plans.rules import COLUMNS
from tamiz.runtime import materialize, scratch_path
from tamiz.sources import html_tables, ingest, pages, snapshots, tables
from tamiz.streaming.incremental import run_available, run_ingest

from . import duck as d
from .fixtures import DIRTY_TEXT, HTML_FILES, duck, fixture, spread, table
from .registry import query

FX1, FX6 = duck(DIRTY_TEXT), duck(HTML_FILES)
KEYS = ["source", "doc_id"]
LINK = r'<a href="([^"]+)">([^<]*)</a>'
TITLE = r"(?is)<title>([^<]*)</title>"
ITEM = r"(?i)<li>"


def _entities(e: str) -> str:
    for a, b in (("&quot;", '"'), ("&iacute;", "í"), ("&#209;", "Ñ"), ("&#x41;", "A"), ("&nbsp;", " "),
                 ("&amp;", "&")):
        e = f"replace({e}, '{a}', '{b}')"
    return e


def _rows_cte() -> str:
    text = "regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script>', '', 'g'), '(?s)<!--.*?-->', '', 'g')"
    cell = d.norm(_entities("regexp_replace(c, '(?s)<[^>]*>', '', 'g')"))
    return f"""
WITH docs AS ({FX6}),
tr AS (SELECT source, doc_id, list_filter(list_transform(
    regexp_extract_all({text}, '(?is)<tr\\b[^>]*>(.*?)</tr\\s*>', 1),
    lambda r: list_transform(regexp_extract_all(r, '(?is)<td\\b[^>]*>(.*?)</td\\s*>', 1), lambda c: {cell})),
    lambda x: len(x) > 0) AS trs FROM docs),
ex AS (SELECT source, doc_id, CAST(unnest(range(len(trs))) AS BIGINT) AS pos, unnest(trs) AS cells FROM tr),
hd AS (SELECT source, doc_id, min(pos) FILTER (WHERE upper(cells[1]) = 'CODIGO'
    AND list_contains(list_transform(cells, lambda c: upper(c)), 'ESTABLECIMIENTO')) AS header FROM ex GROUP BY 1, 2)"""


@query("html_table_rows", f"""{_rows_cte()}
SELECT source, doc_id, pos, array_to_string(cells, '|') AS cells FROM ex""")
def html_table_rows(spark, sf):
    rows = html_tables.html_table_rows(fixture(spark, sf, HTML_FILES), KEYS)
    return rows.select(*KEYS, F.col("pos").cast("bigint").alias("pos"), F.array_join("cells", "|").alias("cells"))


@query("html_header_index", f"{_rows_cte()} SELECT source, doc_id, header FROM hd")
def html_header_index(spark, sf):
    out = html_tables.html_header_index(fixture(spark, sf, HTML_FILES), KEYS)
    return out.withColumn("header", F.col("header").cast("bigint"))


@query("html_records", f"""{_rows_cte()}
SELECT ex.source, ex.doc_id, pos, {', '.join(f"coalesce(cells[{i + 1}], '') AS {c}" for i, c in enumerate(COLUMNS))}
FROM ex JOIN hd ON hd.source = ex.source AND hd.doc_id = ex.doc_id
WHERE pos > header AND regexp_matches(cells[1], '{d.CODE}')""")
def html_records(spark, sf):
    out = html_tables.html_records(fixture(spark, sf, HTML_FILES), KEYS, COLUMNS)
    return out.withColumn("pos", F.col("pos").cast("bigint"))


@query("page_fields_map", f"""
WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '{LINK}', 1)) AS k, unnest(regexp_extract_all(html, '{LINK}', 2)) AS v,
    unnest(range(len(regexp_extract_all(html, '{LINK}', 1)))) AS i FROM pages),
m AS (SELECT page_id, k, arg_max(v, i) AS v FROM l GROUP BY 1, 2),
s AS (SELECT page_id, count(*) AS n, string_agg(k || '=' || v, '|' ORDER BY k) AS fields FROM m GROUP BY 1)
SELECT pages.page_id, coalesce(n, 0) AS n_fields, coalesce(fields, '') AS fields
FROM pages LEFT JOIN s ON s.page_id = pages.page_id""")
def page_fields_map(spark, sf):
    df = table(spark, sf, "pages").select("page_id", pages.fields_map(F.col("html"), LINK).alias("m"))
    entries = F.array_sort(F.map_entries("m"))
    return df.select(
        "page_id",
        F.size("m").cast("bigint").alias("n_fields"),
        F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|").alias("fields"),
    )


@query("page_first_match", f"SELECT page_id, coalesce(regexp_extract(html, '{TITLE}', 1), '') AS title FROM pages")
def page_first_match(spark, sf):
    return table(spark, sf, "pages").select("page_id", pages.first_match(F.col("html"), TITLE).alias("title"))


@query("page_code_count", f"""
SELECT 'pages' AS source, page_id AS id, len(regexp_extract_all(html, '{ITEM}')) AS hits,
  len(regexp_extract_all(html, '{ITEM}')) > 0 AS accepted FROM pages
UNION ALL SELECT source, doc_id, len(regexp_extract_all(html, '[0-9]{{2}}-[0-9]{{2}}-[0-9]{{4}}-[0-9]{{2}}')),
  len(regexp_extract_all(html, '[0-9]{{2}}-[0-9]{{2}}-[0-9]{{4}}-[0-9]{{2}}')) > 0 FROM ({FX6})""")
def page_code_count(spark, sf):
    web = pages.accept_pages(table(spark, sf, "pages"), pattern=ITEM)
    files = pages.accept_pages(fixture(spark, sf, HTML_FILES))
    return web.select(
        F.lit("pages").alias("source"), F.col("page_id").alias("id"), F.col("hits").cast("bigint").alias("hits"), "accepted"
    ).unionByName(
        files.select("source", F.col("doc_id").alias("id"), F.col("hits").cast("bigint").alias("hits"), "accepted")
    )


def _sources(spark, sf):
    parts = []
    for name, key, label in (("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name"),
                             ("part", "p_partkey", "p_name")):
        parts.append(
            table(spark, sf, name).select(
                F.lit(name).alias("source"), F.col(key).alias("pos"), F.col(label).alias("name")
            )
        )
    return tables.consolidate(parts)


_SOURCES = """SELECT 'customer' AS source, c_custkey AS pos, c_name AS name FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier UNION ALL SELECT 'part', p_partkey, p_name FROM part"""


@query("consolidate_union", _SOURCES)
def consolidate_union(spark, sf):
    return _sources(spark, sf)


@query("row_lineage", f"""
SELECT source, pos, name, row_number() OVER (ORDER BY source, pos) + 1 AS row_number FROM ({_SOURCES})""")
def row_lineage(spark, sf):
    return tables.number_rows(_sources(spark, sf), "source", "pos")


#: A raw file holds the customers of one nation whose keys lie in one range of so many.
KEYS_IN_FILE = 500
#: Raw rows for whose files one task is enough.
ROWS_IN_TASK = 5_000
_CODE = "concat(lpad(CAST(k % 90 + 10 AS STRING), 2, '0'), '-01-', lpad(CAST(k % 10000 AS STRING), 4, '0'), '-46')"
#: Raw rows (stem, file, n, k): nation, number of its file, number of the nation, customer.
_RAW = f"""SELECT n_name AS stem, CAST(floor(c_custkey / {KEYS_IN_FILE}) AS INT) AS file, n_nationkey AS n, c_custkey AS k
FROM customer JOIN nation ON c_nationkey = n_nationkey"""


def _markup(rows):
    """(stem, file, value): one HTML document for each raw file, cells and rows closed or not; value is its markup."""
    code = F.expr(_CODE)
    closed = F.concat(F.lit("<tr><td>"), code, F.lit("</td><td>x</td></tr>"))
    loose = F.concat(F.lit("<tr><td>"), code, F.lit("<td>x"))
    body = F.array_join(F.array_sort(F.collect_list(F.when(F.col("k") % 2 == 0, closed).otherwise(loose))), "")
    head = "<table><tr><td>Listado</td></tr><tr><td>Codigo</td><td>DISTRITO</td><td>Establecimiento</td></tr>"
    # nations by number: 4 of 5 have no header row in their first file
    header = F.when((F.first("n") % 5 == 4) & (F.col("file") == 0), F.lit("<table>")).otherwise(F.lit(head))
    return rows.groupBy("stem", "file").agg(F.concat(header, F.coalesce(body, F.lit("")), F.lit("</table>")).alias("value"))


def _write_markup(docs, path, parts):
    """Add the files to ``path``, as many at a time as there are tasks; a task moves its own into place."""
    writer = docs.repartition(parts, "stem", "file").write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.partitionBy("stem", "file").text(path)


def _stem(path):
    """The raw files of a nation are those of its folder."""
    return F.regexp_extract(path, "/stem=([^/]+)/", 1)


def _raw_files(spark, sf):
    """The raw files of all customers, written once more for each caller, and their rows."""
    customer = table(spark, sf, "customer")
    joined = spread(customer).join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = joined.select(
        F.col("n_name").alias("stem"), F.floor(F.col("c_custkey") / KEYS_IN_FILE).cast("int").alias("file"),
        F.col("n_nationkey").alias("n"), F.col("c_custkey").alias("k"),
    )
    path, parts = scratch_path(spark, "raw"), 1 + customer.count() // ROWS_IN_TASK
    _write_markup(_markup(rows), path, parts)
    return path, rows, parts


@query("source_catalog", f"""
SELECT upper(stem) AS source, count(DISTINCT file) AS files FROM ({_RAW}) GROUP BY 1""")
def source_catalog(spark, sf):
    """From the names of raw files; their content is not read."""
    path, _, _ = _raw_files(spark, sf)
    files = ingest.list_files(spark, f"{path}/*/*", _stem)
    counts = files.groupBy(F.upper("source").alias("source")).agg(F.count("*").alias("files"))
    return ingest.source_catalog(files, source=_stem).join(counts, "source")


# What a nation's files hold after the changes, by its number: 0 as before, 1 one of several files changed, 2 emptied,
# 3 gone, 4 as before, with a file that is rejected.
_AFTER = "n % 5 <> 3 AND NOT (n % 5 = 1 AND file = 0 AND k % 3 <> 0) AND n % 5 <> 2"
_LOADED = "NOT (n % 5 = 4 AND file = 0)"


@query("ingest_cycle", f"""
WITH raw AS ({_RAW}),
first AS (SELECT stem, n, count(*) FILTER ({_LOADED}) AS filas FROM raw GROUP BY 1, 2),
after AS (SELECT stem, n, count(*) FILTER ({_AFTER} AND {_LOADED}) AS filas FROM raw WHERE n % 5 <> 3 GROUP BY 1, 2),
runs AS (SELECT 1 AS run, stem AS source, '{ingest.STATUS_DONE}' AS estado, filas FROM first
  UNION ALL SELECT 2, stem, '{ingest.STATUS_SKIPPED}', filas FROM first
  UNION ALL SELECT 3, stem, CASE WHEN n % 5 IN (1, 2) THEN '{ingest.STATUS_DONE}' ELSE '{ingest.STATUS_SKIPPED}' END, filas FROM after
  UNION ALL SELECT 4, stem, '{ingest.STATUS_DONE}', filas FROM after)
SELECT run, source, estado, filas, CAST(NULL AS BIGINT) AS codes FROM runs
UNION ALL SELECT run, '{ingest.TOTAL}', '', CAST(sum(filas) AS BIGINT), NULL FROM runs GROUP BY run
UNION ALL SELECT 5, stem, 'table', count(*), CAST(sum(CAST(substr({_CODE.replace('STRING', 'VARCHAR')}, 7, 4) AS BIGINT)) AS BIGINT)
  FROM raw WHERE {_AFTER} AND {_LOADED} GROUP BY stem
UNION ALL SELECT 5, stem, 'rejected', count(*), NULL FROM raw WHERE NOT ({_LOADED}) GROUP BY stem""")
def ingest_cycle(spark, sf):
    """First load, nothing new, changed, emptied and deleted files, all again by force; then the table and its rejects."""
    path, rows, parts = _raw_files(spark, sf)
    args = (spark, f"{path}/*/*", scratch_path(spark, "ingest"), COLUMNS)
    root, runs = args[2], []

    def load(**options):
        out = ingest.ingest(*args, source=_stem, **options)
        runs.append(materialize(out.select(F.lit(len(runs) + 1).alias("run"), "source", "estado", "filas"), "run"))

    load()
    load()
    files = rows.select("stem", "file", "n").distinct()
    changed = files.filter("n % 5 = 2 OR (n % 5 = 1 AND file = 0)").join(
        rows.filter(_AFTER).select("stem", "file", "k"), ["stem", "file"], "left"
    )
    for r in files.filter("n % 5 IN (1, 2, 3)").select("stem", "n").distinct().collect():  # nations
        snapshots.delete(spark, f"{path}/stem={r['stem']}" + ("/file=0" if r["n"] % 5 == 1 else ""))
    _write_markup(_markup(changed), path, parts)
    load()
    load(force=True)
    records = snapshots.records(spark, root, COLUMNS)
    stored = records.groupBy("source").agg(
        F.count("*").alias("filas"), F.sum(F.substring("CODIGO", 7, 4).cast("bigint")).alias("codes")
    )
    bad = snapshots.rejected(spark, root).groupBy("source").agg(F.sum("rows").alias("filas"))
    return tables.consolidate(runs).withColumn("codes", F.lit(None).cast("bigint")).unionByName(
        stored.select(F.lit(5).alias("run"), "source", F.lit("table").alias("estado"), "filas", "codes")
    ).unionByName(
        bad.select(F.lit(5).alias("run"), "source", F.lit("rejected").alias("estado"), "filas", F.lit(None).cast("bigint").alias("codes"))
    )


@query("ingest_stream", f"""
SELECT stem AS source, count(*) AS filas, CAST(sum(CAST(substr({_CODE.replace('STRING', 'VARCHAR')}, 7, 4) AS BIGINT)) AS BIGINT) AS codes
FROM ({_RAW}) WHERE {_LOADED} GROUP BY stem""")
def ingest_stream(spark, sf):
    """The same files as a stream of small batches that replace the sources they touch; a run without new files changes nothing."""
    path, _, _ = _raw_files(spark, sf)
    root, checkpoint = scratch_path(spark, "ingest"), scratch_path(spark, "checkpoint")
    for _ in range(2):
        run_ingest(spark, path, root, COLUMNS, checkpoint, max_files=200, source=_stem).awaitTermination()
    return snapshots.records(spark, root, COLUMNS).groupBy("source").agg(
        F.count("*").alias("filas"), F.sum(F.substring("CODIGO", 7, 4).cast("bigint")).alias("codes")
    )


@query("ingest_summary", f"""
WITH rec AS (SELECT n_name AS source, CASE WHEN n_nationkey IN (SELECT s_nationkey FROM supplier)
    THEN '{ingest.STATUS_SKIPPED}' ELSE '{ingest.STATUS_DONE}' END AS estado
  FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT source, estado, count(*) AS filas FROM rec GROUP BY 1, 2
UNION ALL SELECT '{ingest.TOTAL}', '', count(*) FROM rec""")
def ingest_summary(spark, sf):
    nation = table(spark, sf, "nation")
    known = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("known")).distinct()
    records = (
        table(spark, sf, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(known, F.col("n_nationkey") == F.col("known"), "left")
        .select(
            F.col("n_name").alias("source"),
            F.when(F.col("known").isNotNull(), F.lit(ingest.STATUS_SKIPPED))
            .otherwise(F.lit(ingest.STATUS_DONE)).alias("estado"),
        )
    )
    return ingest.ingest_summary(records)


@query("incremental_antijoin", """
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def incremental_antijoin(spark, sf):
    sources = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    manifest = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return ingest.new_sources(sources, manifest, ["o_orderkey"])


_CSV = ["row_id", "name", "address", "supervisor", "director"]


@query("csv_text_scan", f"""
SELECT CAST(row_id AS VARCHAR) AS row_id, name, address, supervisor, {d.strip('director')} AS director FROM ({FX1})""")
def csv_text_scan(spark, sf):
    df = fixture(spark, sf, DIRTY_TEXT)
    path = scratch_path(spark, "csv")
    tables.write_csv(df.select(*_CSV), path)
    plain = tables.read_text_csv(spark, path, _CSV, multi_line=True)
    stripped = tables.read_text_csv(spark, path, _CSV, multi_line=True, stripped=True)
    return plain.drop("director").join(stripped.select("row_id", "director"), "row_id")


@query("csv_by_name", f"""
SELECT CAST(row_id AS VARCHAR) AS row_id, nullif(director, '') AS director, nullif(address, '') AS address FROM ({FX1})""")
def csv_by_name(spark, sf):
    """Columns in another order than wanted and one too many; blanks as NULL."""
    path = scratch_path(spark, "csv")
    tables.write_csv(fixture(spark, sf, DIRTY_TEXT).select("supervisor", "address", "row_id", "director"), path)
    return tables.read_text_csv(spark, path, ["row_id", "director", "address"], multi_line=True, blank_as_null=True)


@query("sink_roundtrip", """
SELECT n_name AS source, count(*) AS filas, CAST(sum(c_custkey) AS BIGINT) AS keys, min(c_name) AS first_name
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def sink_roundtrip(spark, sf):
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("source"))
    customers = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    path = scratch_path(spark, "by-source")
    tables.write_by_source(customers.select("source", "c_custkey", "c_name"), path)
    return spark.read.parquet(path).groupBy("source").agg(
        F.count("*").alias("filas"), F.sum("c_custkey").alias("keys"), F.min("c_name").alias("first_name")
    )


@query("stream_pages", f"""
SELECT page_id, coalesce(regexp_extract(html, '{TITLE}', 1), '') AS title,
  len(regexp_extract_all(html, '{ITEM}')) AS hits FROM pages""")
def stream_pages(spark, sf):
    schema = spark.read.parquet(f"{sf}/pages.parquet").schema
    # a pattern stands for a table that is one file as well as for a folder of files
    stream = spark.readStream.schema(schema).parquet(f"{sf}/page[s].parquet")
    parsed = stream.select(
        F.lit("pages").alias("source"), "page_id",
        pages.first_match(F.col("html"), TITLE).alias("title"),
        pages.count_hits(F.col("html"), ITEM).cast("bigint").alias("hits"),
    )
    out = scratch_path(spark, "stream")
    run_available(parsed, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return spark.read.schema(parsed.schema).parquet(f"{out}/table").select("page_id", "title", "hits")
