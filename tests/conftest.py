from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from footfall.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_log(spark):
    """A log from (user, item, category, type, 'yyyy-MM-dd HH') rows."""
    from pyspark.sql import functions as F

    from footfall import schema
    from footfall.functions.timeparts import parse_hour

    def make(rows):
        text = spark.createDataFrame(rows, schema.LOG_TEXT)
        return text.withColumn("time", parse_hour(F.col("time")))

    return make
