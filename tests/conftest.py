import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from lakemart.session import build_session

    session = build_session("lakemart-tests", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    })
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a frame as a sorted list of tuples."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(row) for row in picked.collect()), key=repr)

    return collect


@pytest.fixture
def values(spark):
    """One expression applied to a list of texts."""
    from pyspark.sql import functions as F

    def apply(expression, texts, kind="string"):
        frame = spark.createDataFrame(list(enumerate(texts)), f"n int, x {kind}")
        found = frame.select("n", expression(F.col("x")).alias("y")).collect()
        return [row["y"] for row in sorted(found)]

    return apply
