"""Incremental ingest of HTML-table files into a table of snapshots by source."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..runtime import materialize, small_parts
from . import snapshots
from .html_tables import decode_files, documents, parsed_records, rejects, source_name
from .tables import write_by_source

# What happened to a source, and the label of the total.
STATUS_DONE = "generado"
STATUS_SKIPPED = "omitido (ya existe)"
TOTAL = "Total consolidado"
FILE_KEY = ["path", "modificationTime", "length"]


def source_catalog(paths: DataFrame, path: str = "path", source: Callable[[Column], Column] = source_name) -> DataFrame:
    """Upper-cased source names, by default file stems, distinct."""
    return paths.select(F.upper(source(F.col(path))).alias("source")).distinct()


def new_sources(sources: DataFrame, manifest: DataFrame, keys: list[str] = FILE_KEY) -> DataFrame:
    """Sources the manifest does not list; a changed file counts as new."""
    return sources.join(manifest.select(*keys).distinct(), keys, "left_anti")


def with_total(per_source: DataFrame, source: str, status: str) -> DataFrame:
    total = per_source.agg(F.coalesce(F.sum("filas"), F.lit(0)).alias("filas"))
    return per_source.unionByName(total.select(F.lit(TOTAL).alias(source), F.lit("").alias(status), "filas"))


def ingest_summary(records: DataFrame, source: str = "source", status: str = "estado") -> DataFrame:
    """Rows per source with its status, and the total over all sources."""
    return with_total(records.groupBy(source, status).agg(F.count("*").alias("filas")), source, status)


def list_files(spark: SparkSession, pattern: str, source: Callable[[Column], Column] = source_name) -> DataFrame:
    """(path, modificationTime, length, source) of the files; their content is not read."""
    files = spark.read.format("binaryFile").load(pattern)
    return files.select(*FILE_KEY, source(F.col("path")).alias("source"))


def _read(spark: SparkSession, files: DataFrame, charset: str) -> DataFrame:
    """(source, path, html) of the listed files and no others."""
    paths = [r["path"] for r in files.select("path").collect()]  # the driver has listed them anyway
    content = spark.read.format("binaryFile").load(paths) if paths else spark.read.format("binaryFile").schema(
        "path string, modificationTime timestamp, length bigint, content binary"
    ).load([])
    return decode_files(content, charset).drop("source").join(files.select("path", "source"), "path").select("source", "path", "html")


def write_snapshot(
    spark: SparkSession, root: str, todo: DataFrame | None, kept: DataFrame, columns: list[str], label: str,
    charset: str = "ISO-8859-1", unclosed: str = "end", before_publish: Callable[[int], None] | None = None,
    parsed: DataFrame | None = None, last: int | None = None, again: Callable[[], tuple[DataFrame, DataFrame] | None] | None = None,
) -> int:
    """Read the files ``todo``, keep the entries ``kept`` of the file list, publish both as the next snapshot.

    Each file is read and parsed once, or not at all when the caller has the stored rows ``parsed`` of ``parsed_records``, each file
    with its source and FILE_KEY; these then are the files to do. ``last`` is the number of the last snapshot when the caller knows it.
    ``again`` is called while these files are written. It may return the entries to keep in place of ``kept``, and the stored rows of further files.
    Documents without a header row go to the reject table and end nothing.
    """
    number = (snapshots.current(spark, root) if last is None else last) + 1
    for kind in ("data", "rejects"):  # what a run that ended early may have left
        snapshots.delete(spark, snapshots.batch_path(root, kind, number))
    names = [f.partition(" ")[0] for f in snapshots.FILES.split(", ")]
    batch = F.lit(number).cast("bigint").alias("batch")

    def entries(parsed: DataFrame) -> DataFrame:
        return documents(parsed, ["source", *FILE_KEY]).select("*", batch).coalesce(1)  # no more than a batch has files

    def write_records(parsed: DataFrame, _: DataFrame, mode: str) -> None:
        found = parsed.filter("pos IS NOT NULL").select("source", "path", "pos", *columns)
        write_by_source(found, snapshots.batch_path(root, "data", number), mode=mode)

    def write_rejects(_: DataFrame, read: DataFrame, mode: str) -> None:
        without = read.filter("header IS NULL")
        if not without.isEmpty():
            rejects(_read(spark, without, charset), ["source", "path"], unclosed=unclosed).write.mode(mode).parquet(
                snapshots.batch_path(root, "rejects", number)
            )

    read = None
    if parsed is not None:
        read = entries(parsed)
    elif not todo.isEmpty():
        parsed = materialize(parsed_records(_read(spark, todo, charset), ["source", "path"], columns, unclosed=unclosed), "records")
        counts = documents(parsed, ["path"]).groupBy("path").agg(F.max("rows").alias("rows"), F.sum("filas").alias("filas"), F.max("header").alias("header"))
        read = materialize(todo.join(counts, "path", "left").select("*", batch), "files")
    # Records, rejects and list are written at the same time: each alone leaves most cores idle when it is small.
    with small_parts(spark), ThreadPoolExecutor(2) as pool:

        def start(*args) -> list[Future]:
            return [pool.submit(inheritable_thread_target(spark)(f), *args) for f in (write_records, write_rejects)]

        others = [] if read is None else start(parsed, read, "overwrite")
        if again is not None and (more := again()) is not None:
            kept, further = more
            wait(others)
            others += start(further, entries(further), "append")
            read = read.unionByName(entries(further))
        files = (spark.createDataFrame([], snapshots.FILES) if read is None else read).select(*names).unionByName(kept.select(*names))
        files.write.mode("overwrite").parquet(snapshots.snapshot_path(root, number))
        for other in others:
            other.result()
    if before_publish is not None:
        before_publish(number)
    snapshots.publish(spark, root, number, label)
    return number


def ingest(
    spark: SparkSession, pattern: str, root: str, columns: list[str], force: bool = False,
    source: Callable[[Column], Column] = source_name, charset: str = "ISO-8859-1", unclosed: str = "end",
    before_publish: Callable[[int], None] | None = None,
) -> DataFrame:
    """Bring the table at ``root`` up to date with the files of ``pattern``; with ``force`` read all files again.

    A source is all files of one name, by default one stem. When one of them is
    new, has changed or is gone, the whole source is read again; the others
    keep their folder. The result is one new snapshot, or none when nothing
    changed; see :mod:`.snapshots`. Returns the ingest summary: every source that has
    files, also with zero rows, and the total.
    ``before_publish`` is called with the number of a snapshot that is written but not yet published.
    """
    seen = materialize(list_files(spark, pattern, source), "files")
    known = snapshots.file_list(spark, root)
    base = known.limit(0) if force else known
    touched = new_sources(seen, base).select("source").unionByName(new_sources(known, seen).select("source"))
    touched = materialize(touched.distinct(), "touched")
    if not touched.isEmpty():
        todo = materialize(seen.join(touched, "source", "left_semi"), "todo")
        kept = known.join(touched, "source", "left_anti")
        write_snapshot(spark, root, todo, kept, columns, "load", charset, unclosed, before_publish)
    return summary(spark, root, touched)


def summary(spark: SparkSession, root: str, touched: DataFrame) -> DataFrame:
    """Rows of every source of the last snapshot; those in ``touched`` were read again."""
    files = snapshots.file_list(spark, root).groupBy("source").agg(F.sum("filas").alias("filas"))
    status = F.when(F.col("_touched"), F.lit(STATUS_DONE)).otherwise(F.lit(STATUS_SKIPPED))
    per_source = files.join(touched.select("source", F.lit(True).alias("_touched")), "source", "left").select(
        "source", status.alias("estado"), F.coalesce("filas", F.lit(0)).alias("filas")
    )
    return with_total(per_source, "source", "estado")
