from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sievewright.session import local_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ship_package()
    session = local_session("tests", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def column(spark):
    """Values of a column expression over a list of inputs, in input order."""
    from pyspark.sql import functions as F

    def run(values, expression, dtype="string"):
        df = spark.createDataFrame(list(enumerate(values)), f"i int, x {dtype}")
        rows = df.select("i", expression(F.col("x")).alias("y")).collect()
        return [r["y"] for r in sorted(rows, key=lambda r: r["i"])]

    return run
