"""Session defaults.

Only runtime SQL settings are touched, and only those the submitter left open,
so ``spark-submit --conf`` always wins.
"""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()

PARTITIONS = "spark.sql.shuffle.partitions"
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Fixed value: Spark's own default.
SPARK_PARTITIONS = 200
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
STATE_STORE = {
    # Window state lives in RocksDB on the executors' disks, not on their heap.
    # Each micro-batch uploads a change log instead of a full snapshot, and a
    # stream join keeps one store per partition instead of four.
    PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}
# To keep the number of state rows, RocksDB looks every key up before it writes or removes it.
COUNT_STATE = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Half as many scan tasks as by default; small tables are still split over
    # all cores.
    "spark.sql.files.maxPartitionBytes": "256m",
}


def get_spark(
    app_name: str = "voltstream",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **static_conf: str,
) -> SparkSession:
    """Return the session, with UTC as its zone and the defaults above.

    ``static_conf`` takes settings that must exist before the JVM starts; write
    ``spark_driver_memory="8g"`` for ``spark.driver.memory``.

    ``shuffle_partitions`` defaults to twice the cluster's cores, but never below
    Spark's own default: executors may still be on their way when a session starts.
    A batch shuffle starts with four times as many, and adaptive execution joins
    the small ones. For streams see ``voltstream.streaming.run.start``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in static_conf.items():
        builder = builder.config(key.replace("_", "."), value)
    spark = builder.getOrCreate()

    given = spark.sparkContext.getConf()
    settings = DEFAULTS if given.contains(PROVIDER) else {**DEFAULTS, **STATE_STORE}
    for key, value in settings.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    if shuffle_partitions or not given.contains(PARTITIONS):
        number = shuffle_partitions or sized_partitions(spark)
        spark.conf.set(PARTITIONS, str(number))
        if not given.contains(INITIAL_PARTITIONS):
            spark.conf.set(INITIAL_PARTITIONS, str(4 * number))
    return use_utc(spark)


def sized_partitions(spark: SparkSession) -> int:
    """Shuffle partitions for the cores at hand, at least as many as Spark's default."""
    return max(SPARK_PARTITIONS, 2 * spark.sparkContext.defaultParallelism)


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone to UTC, the zone of every timestamp in this package."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per application.

    Row functions that live in it are looked up by name there. Not needed where the
    job was submitted with ``--py-files`` or the package is installed.
    """
    context = spark.sparkContext
    package = Path(__file__).resolve().parent
    if package.is_dir() and context.applicationId not in _shipped:
        archive = shutil.make_archive(
            f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name
        )
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return spark
