import os

import pytest
from pyspark.sql import functions as F

from voltstream.queries import events
from voltstream.session import get_spark, ship_package

TABLES = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "tests",
        master="local[4]",
        shuffle_partitions=4,
        spark_driver_memory="4g",
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("OFF")
    yield ship_package(session)
    session.stop()


@pytest.fixture(scope="session")
def tables():
    return TABLES


@pytest.fixture(scope="session")
def event_quarters(spark, tables, tmp_path_factory):
    """The events as four Parquet files, a quarter of the time range in each."""
    folder = tmp_path_factory.mktemp("quarters")
    frame = events(spark, tables)
    quarter = frame.count() // 4
    files = []
    for n in range(4):
        part = str(folder / f"part-{n}")
        low, high = n * quarter, (n + 1) * quarter if n < 3 else 2**62
        rows = frame.where(F.col("event_id").between(low, high - 1))
        rows.coalesce(1).write.parquet(part)
        (data,) = (f for f in os.listdir(part) if f.endswith(".parquet"))
        files.append(f"{part}/{data}")
    return files
