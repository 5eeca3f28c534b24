import os
import sys
from datetime import date

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.driver.memory", "6g")
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.sql.codegen.factoryMode", "NO_CODEGEN")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def series(spark):
    """Rows (symbol, date, value) from {symbol: [(ISO date, value), ...]}."""

    def make(data, val="value", kind="double", ent="symbol", dt="date"):
        rows = [(e, date.fromisoformat(d), v) for e, points in data.items() for d, v in points]
        return spark.createDataFrame(rows, f"{ent} string, {dt} date, {val} {kind}")

    return make


@pytest.fixture
def days():
    """n consecutive ISO dates from a start."""
    from datetime import timedelta

    def make(start, n):
        first = date.fromisoformat(start)
        return [(first + timedelta(days=i)).isoformat() for i in range(n)]

    return make
