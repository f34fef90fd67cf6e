import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("vigil-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Values of an expression over one string column ``x``."""

    def values(texts, expression):
        frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
        return [r.y for r in frame.select("i", expression.alias("y")).orderBy("i").collect()]

    return values


def rows(frame):
    """Rows as a sorted list of tuples, nulls first."""
    key = lambda row: tuple((v is not None, v if v is not None else 0) for v in row)
    return sorted((tuple(r) for r in frame.collect()), key=key)
