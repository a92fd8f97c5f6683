import os

import pytest
from pyspark.sql import functions as F

from tamiz.plans.rules import COLUMNS
from tamiz.sources import html_tables, ingest, pages, snapshots, tables
from tamiz.streaming.incremental import ingest_batch, run_available, run_ingest, stream_records
from workload import source_queries
from workload.all_queries import QUERIES

HEADER = "<tr>" + "".join(f"<td>{c.title()}</td>" for c in COLUMNS) + "</tr>"


def page(*codes, extra=""):
    rows = "".join(f"<tr><td>{c}</td><td>01-403</td><td>Petén &ntilde;&#241;</td></tr>" for c in codes)
    return (
        "<html><script>var a='<tr><td>CODIGO</td></tr>';</script><table><tr><td>Listado</td></tr>"
        f"{HEADER}{rows}{extra}<tr><td>Total</td></tr></table></html>"
    ).encode("latin-1")


def write(folder, name, data):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.xls", "wb") as handle:
        handle.write(data)


def test_latin1_files(spark, tmp_path):
    folder = str(tmp_path / "raw")
    long_row = "<tr>" + "<td>01-01-0009-46</td>" + "<td>\n x <b>y</b>z </td>" * 20 + "</tr>"
    write(folder, "peten", page("16-01-0137-46", "bad", extra=long_row))
    docs = html_tables.read_html_files(spark, f"{folder}/*.xls")
    rows = html_tables.html_records(docs, ["source"], COLUMNS).orderBy("pos").collect()
    assert [r["CODIGO"] for r in rows] == ["16-01-0137-46", "01-01-0009-46"]
    assert rows[0]["source"] == "peten" and rows[0]["DEPARTAMENTO"] == "Petén ññ"
    assert rows[0]["DEPARTAMENTAL"] == "" and rows[1]["DEPARTAMENTAL"] == "x yz"
    assert html_tables.html_header_index(docs, ["source"]).first()["header"] == 1


def test_document_without_header(spark):
    docs = spark.createDataFrame([("a", "<table><tr><td>x</td></tr></table>"), ("b", ""), ("c", None)], "source string, html string")
    assert {r["header"] for r in html_tables.html_header_index(docs, ["source"]).collect()} == {None}
    assert html_tables.html_records(docs, ["source"], COLUMNS, strict=False).count() == 0
    with pytest.raises(Exception, match="no header row"):
        html_tables.html_records(docs, ["source"], COLUMNS).collect()
    bad = {r["source"]: (r["reason"], r["rows"], r["first"]) for r in html_tables.rejects(docs, ["source"]).collect()}
    assert bad["a"] == (html_tables.NO_HEADER, 1, "x") and bad["b"][0] == bad["c"][0] == html_tables.NO_TABLE


def test_references(one):
    from html import unescape

    values = ["x&nbsp y &ntilde z &#147;q&#148;", "a &amp; b &AMP c", "&lt;x&gt;", "&#209;&#xd1;&Ntilde;", "A&B &nada; &#0; &;", "&notit; &notin;",
              "&hellip;&#x1F600 &#55296; &#1; &#11; &#13;x", "&#99999999999999999999; &#0147;", "x", "", "&", "&&amp;&", "&#xFDD0;|&#x1FFFE;|&#128;|&#129;",
              "&CounterClockwiseContourIntegral;", "&copy2 &copysr; &NotEqualTilde;"]
    assert one(html_tables.unescape_html, [*values, None]) == [*map(unescape, values), None]
    assert unescape(values[0]) == "x\xa0 y ñ z “q”"


LOOSE = [
    ("<tr><td>a</td><td>b<tr><td>c</td></tr>", [["a", "b"], ["c"]], [["c"]]),
    ("<table><tr><td>x&nbsp y &ntilde z &#147;q&#148;</td></tr></table>", [["x y ñ z “q”"]], [["x y ñ z “q”"]]),
    ("<tr><th>h</th><td>1 <b>2</b><td>a < b</tr>tail<td>z</table><td>no", [["1 2", "a < b"], ["z"], ["no"]], []),
    ("<TR ><TD a='1'>k</TD >\n<track><td>\n l </td>n</TR><tr></tr><tr/><td>m</td></tr>", [["k", "l"], ["m"]], [["k", "l"], ["m"]]),
    ("<!-- <tr><td>c</td></tr> --><script>'<tr><td>s'</script>", [], []),
    ("", [], []),
    (None, None, None),
]


def test_loose_markup(one):
    texts = [t for t, _, _ in LOOSE]
    assert one(html_tables.table_rows, texts) == [e for _, e, _ in LOOSE]
    assert one(lambda c: html_tables.table_rows(c, "drop"), texts) == [d for _, _, d in LOOSE]
    with pytest.raises(ValueError):
        html_tables.table_rows(F.col("x"), "guess")


def test_page_fields(one):
    hidden = '<input type="hidden" name="{}" id="i" value="{}" />'
    html = hidden.format("A", "1") + "<INPUT  " + hidden[7:].format("B", "") + hidden.format("A", "2")
    assert one(pages.fields_map, [html, ""]) == [{"A": "2", "B": ""}, {}]
    select = '<select id="z" name="_ctl0:ContentPlaceHolder1:cmbMunicipio">\n <option selected value="07">x</option>'
    assert one(pages.first_match, [select, "x"]) == ["07", ""]
    assert one(pages.count_hits, ["16-01-0137-46 16-01-0138-46x", ""]) == [2, 0]


def _status(summary):
    return {r["source"]: (r["estado"], r["filas"]) for r in summary.collect()}


DONE, SKIPPED = ingest.STATUS_DONE, ingest.STATUS_SKIPPED


def codes(spark, root, number=None):
    rows = snapshots.records(spark, root, COLUMNS, number)
    return sorted((r["source"], r["CODIGO"][6:10]) for r in rows.collect())


def test_incremental_ingest(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "table")
    write(raw, "a", page("16-01-0001-46", "16-01-0002-46"))
    write(raw, "b", page("16-01-0003-46"))
    args = (spark, f"{raw}/*.xls", root, COLUMNS)
    assert _status(ingest.ingest(*args)) == {"a": (DONE, 2), "b": (DONE, 1), ingest.TOTAL: ("", 3)}
    write(raw, "c", page("16-01-0004-46"))
    assert _status(ingest.ingest(*args)) == {
        "a": (SKIPPED, 2), "b": (SKIPPED, 1), "c": (DONE, 1), ingest.TOTAL: ("", 4),
    }
    write(raw, "b", page("16-01-0003-46", "16-01-0005-46"))
    assert _status(ingest.ingest(*args))["b"] == (DONE, 2)
    assert snapshots.current(spark, root) == 3
    assert _status(ingest.ingest(*args))["b"] == (SKIPPED, 2)
    assert snapshots.current(spark, root) == 3  # nothing changed, nothing written
    assert _status(ingest.ingest(*args, force=True))["a"] == (DONE, 2)
    assert len(codes(spark, root)) == 5 and len(codes(spark, root, 1)) == 3
    assert {r["source"] for r in ingest.source_catalog(ingest.list_files(spark, f"{raw}/*.xls")).collect()} == {"A", "B", "C"}
    assert snapshots.expire(spark, root, keep=1) == [1, 2, 3]
    assert len(codes(spark, root)) == 5 and snapshots.markers(spark, root) == [(4, "load")]


def test_ingest_keeps_the_table_equal_to_the_files(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "table")
    for folder, name, code in (("1", "a", "01"), ("2", "a", "02"), ("1", "b", "03"), ("1", "07", "04"), ("1", "x y=é", "05")):
        write(f"{raw}/{folder}", name, page(f"16-01-00{code}-46"))
    args = (spark, f"{raw}/*/*.xls", root, COLUMNS)
    assert _status(ingest.ingest(*args)) == {
        "a": (DONE, 2), "b": (DONE, 1), "07": (DONE, 1), "x y=é": (DONE, 1), ingest.TOTAL: ("", 5)}
    write(f"{raw}/1", "a", page("16-01-0011-46"))  # the other file of this stem stays
    write(f"{raw}/1", "b", page())  # no records left
    os.remove(f"{raw}/1/07.xls")
    assert _status(ingest.ingest(*args)) == {"a": (DONE, 2), "b": (DONE, 0), "x y=é": (SKIPPED, 1), ingest.TOTAL: ("", 3)}
    assert codes(spark, root) == [("a", "0002"), ("a", "0011"), ("x y=é", "0005")]
    os.remove(f"{raw}/1/x y=é.xls")
    assert _status(ingest.ingest(*args, force=True)) == {"a": (DONE, 2), "b": (DONE, 0), ingest.TOTAL: ("", 2)}
    assert codes(spark, root) == [("a", "0002"), ("a", "0011")]
    assert _status(ingest.ingest(*args)) == {"a": (SKIPPED, 2), "b": (SKIPPED, 0), ingest.TOTAL: ("", 2)}


def test_headerless_file_goes_to_the_rejects(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "table")
    write(raw, "a", page("16-01-0001-46"))
    write(raw, "b", b"<table><tr><td>x<td>y</table>")
    args = (spark, f"{raw}/*.xls", root, COLUMNS)
    assert _status(ingest.ingest(*args)) == {"a": (DONE, 1), "b": (DONE, 0), ingest.TOTAL: ("", 1)}
    bad = snapshots.rejected(spark, root).collect()
    assert [(r["source"], r["reason"], r["rows"], r["first"]) for r in bad] == [("b", html_tables.NO_HEADER, 1, "x | y")]
    write(raw, "b", page("16-01-0002-46"))
    assert _status(ingest.ingest(*args))["b"] == (DONE, 1)
    assert snapshots.rejected(spark, root).count() == 0 and codes(spark, root) == [("a", "0001"), ("b", "0002")]


def test_a_run_that_ends_before_publishing_changes_nothing(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "table")
    write(raw, "a", page("16-01-0001-46"))
    write(raw, "b", page("16-01-0002-46"))
    args = (spark, f"{raw}/*.xls", root, COLUMNS)
    ingest.ingest(*args)
    write(raw, "a", page("16-01-0003-46", "16-01-0004-46"))
    os.remove(f"{raw}/b.xls")

    def stop(number):
        raise KeyboardInterrupt(number)

    with pytest.raises(KeyboardInterrupt):
        ingest.ingest(*args, before_publish=stop)
    assert snapshots.current(spark, root) == 1 and codes(spark, root) == [("a", "0001"), ("b", "0002")]
    assert {r["source"] for r in snapshots.file_list(spark, root).collect()} == {"a", "b"}
    write(raw, "c", page("16-01-0005-46"))  # the next run overwrites what the other left
    assert _status(ingest.ingest(*args)) == {"a": (DONE, 2), "c": (DONE, 1), ingest.TOTAL: ("", 3)}
    assert codes(spark, root) == [("a", "0003"), ("a", "0004"), ("c", "0005")]
    assert snapshots.markers(spark, root) == [(1, "load"), (2, "load")]


def test_streaming_ingest(spark, tmp_path):
    raw, table, check = (str(tmp_path / n) for n in ("raw", "table", "check"))
    write(raw, "a", page("16-01-0001-46"))
    for expected, name in ((1, None), (2, "b"), (2, None)):
        if name:
            write(raw, name, page("16-01-0002-46"))
        run_available(stream_records(spark, raw, COLUMNS), table, check).awaitTermination()
        assert spark.read.parquet(table).count() == expected


def test_streaming_ingest_replaces_sources(spark, tmp_path):
    raw, root, check = (str(tmp_path / n) for n in ("raw", "table", "check"))
    write(f"{raw}/1", "a", page("16-01-0001-46"))
    write(f"{raw}/1", "b", page("16-01-0002-46"))
    run_ingest(spark, raw, root, COLUMNS, check).awaitTermination()
    assert codes(spark, root) == [("a", "0001"), ("b", "0002")]
    write(f"{raw}/2", "a", page("16-01-0003-46"))  # a second file of a known source
    for _ in range(2):
        run_ingest(spark, raw, root, COLUMNS, check).awaitTermination()
        assert codes(spark, root) == [("a", "0001"), ("a", "0003"), ("b", "0002")]
    assert [label for _, label in snapshots.markers(spark, root)] == ["stream-0", "stream-1"]


def test_streaming_ingest_reads_earlier_files_only_when_a_source_changes(spark, tmp_path):
    raw, root, check = (str(tmp_path / n) for n in ("raw", "table", "check"))
    for n in (1, 2):
        write(f"{raw}/{n}", "a", page(f"16-01-000{n}-46"))
    run_ingest(spark, raw, root, COLUMNS, check).awaitTermination()
    os.rename(f"{raw}/1", str(tmp_path / "away"))
    write(f"{raw}/3", "a", page("16-01-0003-46"))  # the earlier files of its source are not needed
    run_ingest(spark, raw, root, COLUMNS, check).awaitTermination()
    assert codes(spark, root) == [("a", "0001"), ("a", "0002"), ("a", "0003")]
    assert sorted(r["batch"] for r in snapshots.file_list(spark, root).collect()) == [1, 1, 2]
    os.rename(str(tmp_path / "away"), f"{raw}/1")
    write(f"{raw}/2", "a", page("16-01-0004-46", "16-01-0005-46"))  # a file that is known already
    assert ingest_batch(spark.read.format("binaryFile").load(f"{raw}/2/a.xls"), 2, root, COLUMNS)
    assert codes(spark, root) == [("a", "0001"), ("a", "0003"), ("a", "0004"), ("a", "0005")]
    assert {r["batch"] for r in snapshots.file_list(spark, root).collect()} == {3}


def test_a_stream_takes_few_tasks(spark, tmp_path):
    raw, root, check = (str(tmp_path / n) for n in ("raw", "table", "check"))
    for n in range(60):
        write(f"{raw}/{n}", f"s{n % 3}", page(f"16-01-{n:04d}-46", f"16-01-{n + 60:04d}-46"))
    query = run_ingest(spark, raw, root, COLUMNS, check, max_files=40)
    query.awaitTermination()
    tracker, tasks = spark.sparkContext.statusTracker(), []
    for job in tracker.getJobIdsForGroup(str(query.runId)):
        stages = [tracker.getStageInfo(s) for s in tracker.getJobInfo(job).stageIds]
        tasks.append(sum(s.numCompletedTasks for s in stages if s))
    cores = spark.sparkContext.defaultParallelism
    assert 0 < len(tasks) <= 20 and max(tasks) <= 4 * cores  # for two batches; a task for each file or folder before
    assert len(codes(spark, root)) == 120
    listed = snapshots.file_list(spark, root)
    assert sorted((r["batch"], r["filas"]) for r in listed.collect()) == [(1, 2)] * 40 + [(2, 2)] * 20


def test_documents_of_parsed_rows(spark):
    texts = ["<table><tr><td>x</td></tr></table>", "", None, *(page(*c).decode("latin-1") for c in ((), ("16-01-0001-46", "bad", "16-01-0002-46")))]
    docs = spark.createDataFrame(list(enumerate(texts)), "source int, html string")
    parsed = html_tables.parsed_records(docs, ["source"], COLUMNS)
    found = [tuple(r) for r in html_tables.documents(parsed, ["source"]).orderBy("source").collect()]
    assert [f[:1] + f[2:] for f in found] == [(0, 0, None), (1, 0, None), (2, 0, None), (3, 0, 1), (4, 2, 1)]
    assert [f[1] for f in found if f[0] != 2] == [1, 0, 3, 6]
    assert [tuple(r) for r in parsed.filter("source = 4").orderBy("pos").select("nth", "pos").collect()] == [(0, 2), (1, 4)]


def test_a_batch_without_content_is_read_by_path(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "table")
    write(raw, "a", page("16-01-0001-46"))
    files = spark.read.format("binaryFile").load(f"{raw}/*.xls")
    assert ingest_batch(files.select(*ingest.FILE_KEY), 0, root, COLUMNS)
    assert codes(spark, root) == [("a", "0001")]


def test_raw_files_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(source_queries, "ROWS_IN_TASK", 100)
    spark.range(2000).select(F.col("id").alias("c_custkey"), (F.col("id") % 25).alias("c_nationkey")).coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    spark.range(25).select(F.col("id").cast("int").alias("n_nationkey"), F.concat(F.lit("N"), "id").alias("n_name")).coalesce(1).write.parquet(str(tmp_path / "nation.parquet"))
    path, _, parts = source_queries._raw_files(spark, str(tmp_path))
    files = ingest.list_files(spark, f"{path}/*/*")
    tasks = files.select(F.regexp_extract("path", r"part-(\d+)", 1)).distinct().count()
    assert parts == 21 and files.count() == 100 and tasks > 10


def test_a_replaced_source_keeps_all_its_rejects(spark, tmp_path):
    raw, root, check = (str(tmp_path / n) for n in ("raw", "table", "check"))
    write(f"{raw}/1", "a", b"<table><tr><td>x</table>")
    write(f"{raw}/2", "a", page("16-01-0001-46"))
    write(f"{raw}/3", "a", page("16-01-0002-46"))
    run_ingest(spark, raw, root, COLUMNS, check).awaitTermination()
    write(f"{raw}/2", "a", b"<table><tr><td>y</table>")
    assert ingest_batch(spark.read.format("binaryFile").load(f"{raw}/2/a.xls"), 1, root, COLUMNS)
    assert sorted(r["first"] for r in snapshots.rejected(spark, root).collect()) == ["x", "y"]
    assert codes(spark, root) == [("a", "0002")]
    assert sorted((r["batch"], r["filas"]) for r in snapshots.file_list(spark, root).collect()) == [(2, 0), (2, 0), (2, 1)]


def test_a_published_batch_is_not_read_again(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "table")
    write(raw, "a", page("16-01-0001-46"))
    files = spark.read.format("binaryFile").load(f"{raw}/*.xls").select(*ingest.FILE_KEY)
    assert ingest_batch(files, 0, root, COLUMNS)
    os.remove(f"{raw}/a.xls")
    assert not ingest_batch(files, 0, root, COLUMNS)
    assert codes(spark, root) == [("a", "0001")] and snapshots.current(spark, root) == 1


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "table")
    write(raw, "a", page("16-01-0001-46"))
    files = spark.read.format("binaryFile").load(f"{raw}/*.xls")
    assert ingest_batch(files, 0, root, COLUMNS)
    before = codes(spark, root)
    assert not ingest_batch(files, 0, root, COLUMNS)
    assert codes(spark, root) == before == [("a", "0001")] and snapshots.current(spark, root) == 1
    assert ingest_batch(files, 1, root, COLUMNS)  # the same file in another batch is replaced, not added
    assert codes(spark, root) == before


def test_csv_round_trip(spark, tmp_path):
    rows = [("1", 'say "hi"', "a\nb"), ("2", "", ' x,"y" '), ("3", '"all"', "NA"), ("4", None, "ñ")]
    path = str(tmp_path / "t.csv")
    tables.write_csv(spark.createDataFrame(rows, "k string, a string, b string"), path)
    cols = ["k", "a", "b"]
    got = sorted(tuple(r) for r in tables.read_text_csv(spark, path, cols, True).collect())
    assert got == [(k, a or "", b) for k, a, b in rows]
    nulls = tables.read_text_csv(spark, path, cols, True, blank_as_null=True)
    assert nulls.filter(F.col("a").isNull()).count() == 2
    assert tables.read_text_csv(spark, path, cols, True, stripped=True).filter("b = 'x,\"y\"'").count() == 1


def test_csv_columns_by_name(spark, tmp_path):
    path = str(tmp_path / "n.csv")
    with open(path, "w") as handle:
        handle.write("b,extra,a\n1,2,3\n4,5,\n")
    got = [tuple(r) for r in tables.read_text_csv(spark, path, ["a", "b"], False).collect()]
    assert got == [("3", "1"), ("", "4")]
    with pytest.raises(ValueError, match="no column c"):
        tables.read_text_csv(spark, path, ["a", "c"], False)


def test_empty_report_has_a_header(spark, tmp_path):
    path = str(tmp_path / "empty.csv")
    tables.write_csv(spark.createDataFrame([], "CODIGO string, repeticiones long"), path)
    text = "".join(open(f"{path}/{f}").read() for f in os.listdir(path) if f.endswith(".csv"))
    assert text.strip() == "CODIGO,repeticiones"


def test_write_by_source_keeps_other_sources(spark, tmp_path):
    path = str(tmp_path / "p")
    tables.write_by_source(spark.createDataFrame([("a", 1), ("b", 2)], "source string, v int"), path)
    tables.write_by_source(spark.createDataFrame([("b", 3)], "source string, v int"), path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("source", "v").collect()) == [("a", 1), ("b", 3)]


def test_stream_pages_reads_a_folder_of_files(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"u{i}", f"<title>t{i}</title>" + "<li>" * i) for i in range(6)], "page_id long, url string, html string")
    rows.repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    got = QUERIES["stream_pages"](spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in got) == [(i, f"t{i}", i) for i in range(6)]
    rows.limit(0).write.mode("overwrite").parquet(str(tmp_path / "pages.parquet"))
    assert QUERIES["stream_pages"](spark, str(tmp_path)).count() == 0
