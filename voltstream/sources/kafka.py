"""Kafka topics. Needs the ``spark-sql-kafka-0-10`` package on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltstream.functions.records import read_record


def kafka_values(
    spark: SparkSession,
    servers: str,
    topic: str,
    earliest: bool = False,
    group: str | None = None,
    stream: bool = True,
    arrival: str | None = None,
    **options: str,
) -> DataFrame:
    """The values of a topic as text, in a ``value`` column; keys are dropped.

    ``earliest`` matters for the first start only, later ones follow the
    checkpoint; a ``startingOffsets`` option goes before it. ``arrival`` names a column for the broker's time of each record.
    ``stream=False`` reads what the topic holds now as a batch. Two of Spark's own
    options are worth passing at scale: ``minPartitions`` splits a topic partition
    that holds most of the data over several tasks, and ``maxOffsetsPerTrigger``
    bounds a micro-batch, which keeps window state small during catch-up.
    """
    reader = (spark.readStream if stream else spark.read).format("kafka")
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        **options,
    }
    if stream or earliest:
        settings.setdefault("startingOffsets", "earliest" if earliest else "latest")
    if group:
        settings["groupIdPrefix"] = group
    columns = [F.col("value").cast("string").alias("value")]
    if arrival:
        columns.append(F.col("timestamp").alias(arrival))
    return reader.options(**settings).load().select(*columns)


def kafka_table(
    spark: SparkSession,
    servers: str,
    topic: str,
    schema: str,
    earliest: bool = True,
    fields: tuple[str, ...] | None = None,
    strict: bool = False,
    **options,
) -> DataFrame:
    """A topic of JSON records as a table with the declared columns, or some of them."""
    values = kafka_values(spark, servers, topic, earliest=earliest, **options)
    return read_record(values, schema, strict=strict, fields=fields)
