import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("gantrylake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    from gantrylake.schemas import RAW_TRIP_COLUMNS, RAW_TRIP_SCHEMA

    def build(*rows):
        return spark.createDataFrame([tuple(r[c] for c in RAW_TRIP_COLUMNS) for r in rows], RAW_TRIP_SCHEMA)

    return build


@pytest.fixture
def lake(spark):
    """Lake rows from (day, hour, gantry, type, counts), March 2026."""
    import datetime as dt

    from gantrylake.schemas import LAKE_SCHEMA

    def build(rows):
        full = []
        for day, hour, gantry, code, counts in rows:
            weekday = dt.date(2026, 3, day).isoweekday()
            full.append((2026, 3, day, weekday, hour, gantry, code, counts, (day - 1) // 7 + 1, "202603"))
        return spark.createDataFrame(full, LAKE_SCHEMA)

    return build
