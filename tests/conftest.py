import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [os.path.dirname(os.path.abspath(__file__)), os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]

# Columns can only be built while a session is active, so it starts before the tests are collected.
SESSION = (
    SparkSession.builder.master("local[8]")
    .appName("crawlweft-tests")
    .config("spark.sql.shuffle.partitions", "4")
    .config("spark.sql.session.timeZone", "UTC")
    .config("spark.ui.enabled", "false")
    .config("spark.driver.memory", "6g")
    .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="crawlweft-tests-"))
    .getOrCreate()
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture
def value(spark):
    """Evaluate one column over named constants."""

    def run(column, **constants):
        row = spark.createDataFrame([tuple(constants.values())], ", ".join(f"{k} string" for k in constants))
        return row.select(column.alias("out")).first()["out"]

    return run
