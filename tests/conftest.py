import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corpusloom.settings import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.default.parallelism": "4",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Apply a column function to literal rows and return the results in order."""
    from pyspark.sql import functions as F

    def run(fn, rows, types="a string"):
        rows = [r if isinstance(r, tuple) else (r,) for r in rows]
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"_i int, {types}")
        columns = [F.col(c) for c in df.columns[1:]]
        return [r.v for r in df.select("_i", fn(*columns).alias("v")).orderBy("_i").collect()]

    return run
