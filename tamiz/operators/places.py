"""Standardise department and municipality against a reference catalogue.

The catalogue is a parameter: a two-column table (department, municipality) of
display names. Its accented, upper-cased spelling is the canonical form.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import clean_spaces, fold_key
from ..sources.tables import read_text_csv


@dataclass(frozen=True)
class PlaceRules:
    department: str = "DEPARTAMENTO"
    municipality: str = "MUNICIPIO"
    valid_flag: str = "MUNICIPIO_VALIDO"
    # The district reported by zone, and its zones 1 to 25.
    zoned_department: str = "CIUDAD CAPITAL"
    zone_pattern: str = r"^ZONA ([1-9]|1[0-9]|2[0-5])\z"


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A catalogue from a headed UTF-8 CSV file with the columns department and municipality."""
    return read_text_csv(spark, path, ["department", "municipality"], multi_line=False, blank_as_null=True)


def catalog_dim(catalog: DataFrame) -> DataFrame:
    """(dept_key, muni_key, dept_canonical, muni_canonical), one row per key pair."""
    return (
        catalog.select(
            fold_key(F.col("department")).alias("dept_key"),
            fold_key(F.col("municipality")).alias("muni_key"),
            F.upper("department").alias("dept_canonical"),
            F.upper("municipality").alias("muni_canonical"),
        )
        .groupBy("dept_key", "muni_key")
        .agg(
            F.max("dept_canonical").alias("dept_canonical"),
            F.max("muni_canonical").alias("muni_canonical"),
        )
    )


def standardize_places(
    df: DataFrame, dim: DataFrame, rules: PlaceRules = PlaceRules(), department_flag: str | None = None
) -> DataFrame:
    """Canonical department and municipality plus the validity flag.

    ``department_flag`` names an extra column: is the raw department in the
    catalogue. Both lookups are plain left joins; Spark broadcasts the catalogue
    while it is below its broadcast threshold.
    """
    departments = dim.groupBy(F.col("dept_key").alias("_dk")).agg(
        F.max("dept_canonical").alias("_dc")
    )
    munis = dim.select(
        F.col("dept_key").alias("_mdk"),
        F.col("muni_key").alias("_mk"),
        F.col("muni_canonical").alias("_mc"),
    )
    dept, muni = F.col(rules.department), F.col(rules.municipality)
    keyed = df.select(
        "*",
        fold_key(clean_spaces(dept)).alias("_dept_key"),
        fold_key(clean_spaces(muni)).alias("_muni_key"),
    )
    joined = keyed.join(departments, F.col("_dept_key") == F.col("_dk"), "left").join(
        munis, (F.col("_dept_key") == F.col("_mdk")) & (F.col("_muni_key") == F.col("_mk")), "left"
    )
    zoned = F.col("_dept_key") == rules.zoned_department
    plain = F.upper(clean_spaces(muni))
    new = {
        rules.department: F.when(zoned, F.lit(rules.zoned_department)).otherwise(
            F.coalesce("_dc", "_dept_key")
        ),
        rules.municipality: F.when(zoned, plain).otherwise(F.coalesce(F.col("_mc"), plain)),
        rules.valid_flag: F.when(zoned, plain.rlike(rules.zone_pattern)).otherwise(
            F.col("_mc").isNotNull()
        ),
    }
    if department_flag:
        # The raw value is checked as it came, before invisible characters are replaced.
        raw_key = fold_key(dept)
        new[department_flag] = (raw_key == rules.zoned_department) | (
            F.col("_dc").isNotNull() & (raw_key == F.col("_dept_key"))
        )
    kept = [new[c].alias(c) if c in new else F.col(c) for c in df.columns]
    added = [v.alias(c) for c, v in new.items() if c not in df.columns]
    return joined.select(*kept, *added)


def catalog_rejects(df: DataFrame, cols: list[str], flag: str = "MUNICIPIO_VALIDO") -> DataFrame:
    """Distinct combinations the catalogue does not know, after cleaning."""
    return df.filter(~F.col(flag)).select(*cols).distinct()
