import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    def make(*rows):
        return spark.createDataFrame(
            [(str(i), t) for i, t in enumerate(rows)], "_id string, _text string"
        )

    return make


@pytest.fixture
def annotated(spark):
    """Annotated rows from (text, final_label, auto_label, confidence, reviewed, override)."""

    def make(rows):
        full = [
            (f"id_{i:04d}", *row, *(0.5, False, False)[len(row) - 3 :]) for i, row in enumerate(rows)
        ]
        return spark.createDataFrame(
            full,
            "source_id string, text string, final_label string, auto_label string, "
            "auto_confidence double, is_human_reviewed boolean, human_override boolean",
        )

    return make
