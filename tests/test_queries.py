"""Every registered query against its SQL on the smallest tables."""

import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as spark_entry  # noqa: E402
from workload.fixtures import TABLES  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows_of(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        return None if isinstance(v, float) and math.isnan(v) else round(v, 9) if isinstance(v, float) else v

    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(spark_entry.queries()))
def test_query(spark, duck, name):
    df = spark_entry.queries()[name](spark, SF)
    got = rows_of(df.collect(), df.columns)
    sql = spark_entry.oracle_sql().get(name)
    if sql is None:
        assert df.columns
        return
    result = duck.execute(sql)
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    assert got == rows_of(result.fetchall(), names)


def test_names_agree():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 12
