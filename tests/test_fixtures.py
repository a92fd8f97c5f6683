from pyspark.sql import functions as F

from workload import fixtures


def test_spread_deals_rows_of_one_file_to_many_parts(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    n = 3 * fixtures.ROWS_IN_PART + 1
    spark.range(n).coalesce(1).write.parquet(path)
    rows = fixtures.spread(fixtures.table(spark, str(tmp_path), "t"))
    assert rows.rdd.getNumPartitions() == 4
    assert (rows.count(), rows.distinct().count()) == (n, n)


def test_fixture_is_stored_in_many_files(spark, tmp_path):
    n = 3 * fixtures.ROWS_IN_PART
    spark.range(n).select(F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey")).coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    found = fixtures.fixture(spark, str(tmp_path), fixtures.PHONES)
    assert len(found.inputFiles()) >= 3 and found.count() == n
