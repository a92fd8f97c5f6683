import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tamiz.runtime import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tamiz-tests", "4g")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of a Column function for each of a list of strings."""
    from pyspark.sql import functions as F

    def run(fn, values):
        df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
        return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]

    return run
