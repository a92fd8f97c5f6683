"""A table of sources as versioned snapshots.

Folders below the root of such a table:

    data/batch=<n>/source=<s>/   records, written once and never changed
    rejects/batch=<n>/           documents without a header row
    snapshots/<n>/               the list of files: which source and batch each belongs to
    published/<n>.<label>        an empty file, created last

A snapshot counts when its marker is there. Until then readers see the one
before, so records and file list cannot disagree, whenever a run ends; what an
ended run left is overwritten by the next one, which gets the same number. The
marker is one atomic create on any file system. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FILES = (
    "source string, path string, modificationTime timestamp, length bigint, batch bigint, "
    "rows bigint, filas bigint, header bigint"
)


def _file(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    target, system = _file(spark, path)
    system.delete(target, True)


def markers(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(number, label) of the published snapshots, oldest first."""
    target, system = _file(spark, f"{root}/published")
    if not system.exists(target):
        return []
    names = [status.getPath().getName() for status in system.listStatus(target)]
    return sorted((int(n), label) for n, _, label in (name.partition(".") for name in names) if n.isdigit())


def current(spark: SparkSession, root: str) -> int:
    """The number of the last published snapshot, 0 before the first."""
    found = markers(spark, root)
    return found[-1][0] if found else 0


def publish(spark: SparkSession, root: str, number: int, label: str) -> None:
    target, system = _file(spark, f"{root}/published/{number:012d}.{label}")
    if not system.createNewFile(target):
        raise RuntimeError(f"snapshot {number} of {root} is published already")


def snapshot_path(root: str, number: int) -> str:
    return f"{root}/snapshots/{number:012d}"


def batch_path(root: str, kind: str, number: int) -> str:
    return f"{root}/{kind}/batch={number}"


def file_list(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The files of a snapshot, by default the last published one; no rows before the first."""
    number = current(spark, root) if number is None else number
    if not number:
        return spark.createDataFrame([], FILES)
    return spark.read.schema(FILES).parquet(snapshot_path(root, number))


def _batches(spark: SparkSession, root: str, kind: str, files: DataFrame, schema: str) -> DataFrame:
    """The rows of the batches that a file list names, with columns batch and source."""
    numbers = [r["batch"] for r in files.select("batch").distinct().collect()]  # one for each ingest still in use
    paths = [batch_path(root, kind, n) for n in numbers]
    present = [p for p, (target, system) in zip(paths, map(lambda p: _file(spark, p), paths)) if system.exists(target)]
    schema = f"{schema}, source string, batch bigint"
    if not present:
        return spark.createDataFrame([], schema)
    return spark.read.option("basePath", f"{root}/{kind}").schema(schema).parquet(*present)


def records(spark: SparkSession, root: str, columns: list[str], number: int | None = None) -> DataFrame:
    """(path, pos, columns, source): the records of a snapshot.

    Source and batch are folder names, so the join prunes folders of replaced sources.
    """
    files = file_list(spark, root, number)
    cells = ", ".join(f"`{c}` string" for c in columns)
    rows = _batches(spark, root, "data", files, f"path string, pos int, {cells}")
    used = files.filter("filas > 0").select("source", "batch").distinct()
    return rows.join(used, ["source", "batch"], "left_semi").drop("batch")


def rejected(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """(path, reason, rows, first, source): the documents of a snapshot that have no header row."""
    files = file_list(spark, root, number)
    rows = _batches(spark, root, "rejects", files, "path string, reason string, rows bigint, first string")
    used = files.filter("header IS NULL").select("path", "batch").distinct()
    return rows.join(used, ["path", "batch"], "left_semi").drop("batch")


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Remove all but the last ``keep`` snapshots and the batches none of those uses; returns the batches removed.

    A marker goes before what it stands for. No other run may be writing.
    """
    found = [n for n, _ in markers(spark, root)]
    old, kept = found[: max(0, len(found) - keep)], found[max(0, len(found) - keep) :]
    used = {r["batch"] for n in kept for r in file_list(spark, root, n).select("batch").distinct().collect()}
    for n, label in markers(spark, root):
        if n in old:
            delete(spark, f"{root}/published/{n:012d}.{label}")
            delete(spark, snapshot_path(root, n))
    gone = []
    target, system = _file(spark, f"{root}/data")
    for status in system.listStatus(target) if system.exists(target) else ():
        n = int(status.getPath().getName().partition("=")[2])
        if n not in used:
            gone.append(n)
            delete(spark, batch_path(root, "data", n))
            delete(spark, batch_path(root, "rejects", n))
    return sorted(gone)
