import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vacantia.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def values(spark):
    """Apply a column function to a list of strings."""
    from pyspark.sql import functions as F

    def run(fn, items, kind="string"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
        return [r["o"] for r in rows.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]

    return run
