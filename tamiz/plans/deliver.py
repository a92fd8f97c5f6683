"""The clean table and its five reports as one published set.

Folders below the root: ``<n>/clean`` (Parquet) and one headed CSV folder for each report; the marker
``published/<n>.<label>`` is created last, so readers see a whole set or the one before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.fuzzy import DEFAULT_THRESHOLD
from ..operators.places import PlaceRules
from ..operators.repeated import DETAILS, repeated_names
from ..runtime import materialize
from ..sources import snapshots
from ..sources.tables import read_text_csv, write_csv
from .cleaning import RAW, clean_aligned, transform_log
from .report import duplicate_review, measured, report_of
from .rules import COLUMNS, DERIVED

LOG = ["variable", "problem", "transformation", "affected", "mapped", "reason"]
METRICS = ["ord", "metric", "before", "after"]
PAIRS = [
    "indice_a", "indice_b", "codigo_a", "codigo_b", "establecimiento_a", "establecimiento_b", "similitud_nombre",
    "misma_direccion", "mismo_telefono", "status_a", "status_b", "decision",
]
NAMES = ["departamento", "municipio", "establecimiento", "registros", *DETAILS, "parte", "codigos"]
DECISIONS = ["decision", "pares"]
REPORTS = {
    "transform_log": LOG, "quality_report": METRICS, "duplicate_pairs": PAIRS, "repeated_names": NAMES, "duplicate_decisions": DECISIONS,
}


def publish(
    df: DataFrame, dim: DataFrame, row_col: str, root: str, rules: PlaceRules = PlaceRules(),
    threshold: int = DEFAULT_THRESHOLD, label: str = "clean", before_publish: Callable[[int], None] | None = None,
) -> int:
    """Clean ``df``, write the table and all reports, then publish them together; returns the number of the set.

    ``before_publish`` is called with the number of a set that is written but not yet published.
    A set that was not published is overwritten by the next run.
    """
    spark = df.sparkSession
    number = snapshots.current(spark, root) + 1
    folder = f"{root}/{number:012d}"
    aligned, counts = measured(clean_aligned(df, dim, rules, [row_col], row_col))
    aligned.drop(RAW).write.mode("overwrite").parquet(f"{folder}/clean")
    cleaned = spark.read.parquet(f"{folder}/clean").select(row_col, *COLUMNS, *DERIVED)
    pairs, decisions = duplicate_review(cleaned, row_col, threshold)
    reports = {
        "transform_log": transform_log(aligned, df, counts),
        "quality_report": report_of(aligned, counts, dim, row_col, rules, threshold=threshold),
        "duplicate_pairs": materialize(pairs, "pairs"),
        "repeated_names": repeated_names(cleaned, row_col),
        "duplicate_decisions": decisions,
    }
    for name, columns in REPORTS.items():
        write_csv(reports[name].select(*columns), f"{folder}/{name}")
    if before_publish is not None:
        before_publish(number)
    snapshots.publish(spark, root, number, label)
    return number


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The clean table, or a report as text, of the last published set."""
    number = snapshots.current(spark, root)
    if not number:
        raise FileNotFoundError(f"nothing is published in {root}")
    path = f"{root}/{number:012d}/{name}"
    return spark.read.parquet(path) if name == "clean" else read_text_csv(spark, path, REPORTS[name], multi_line=True)
