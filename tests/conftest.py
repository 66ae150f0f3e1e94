import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clicklake.session import BATCH_CONF  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("clicklake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    for key, value in BATCH_CONF.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a frame as a sorted list of tuples."""
    return lambda frame: sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture
def clicks(spark):
    """Events from (user, product, type, time text[, category]) tuples."""

    def build(*events):
        records = [(i, u, p, t, c[0] if c else None, at) for i, (u, p, t, at, *c) in enumerate(events)]
        frame = spark.createDataFrame(
            records, "event_id bigint, user_id string, product_id string, event_type string, category string, event_time string"
        )
        return frame.selectExpr(
            "event_id", "user_id", "product_id", "event_type", "category",
            "cast(event_time as timestamp) as event_time", "cast(event_time as date) as event_date",
        )

    return build


@pytest.fixture
def plan():
    return lambda frame: frame._jdf.queryExecution().executedPlan().toString()
