import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradewind.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tradewind-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # As on a cluster: the session names the shared folder.
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tradewind-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def make(spark):
    """Small frames: make("a int, b string", (1, "x"), ...)."""

    def build(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return build


def column(df, name, order=None):
    rows = (df.orderBy(order) if order else df).collect()
    return [r[name] for r in rows]
