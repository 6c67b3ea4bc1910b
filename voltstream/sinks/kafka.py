"""Kafka topics. Needs the ``spark-sql-kafka-0-10`` package on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltstream.functions.records import conform, json_text
from voltstream.sinks.base import Sink


def record_frame(frame: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as Kafka records: JSON text in ``value``, the key column in ``key``.

    The broker partitions by key, so no Spark shuffle is needed to keep a
    device's records together and in order.
    """
    value = json_text(frame).alias("value")
    if key is None:
        return frame.select(value)
    return frame.select(F.col(key).cast("string").alias("key"), value)


def text_sink(servers: str, topic: str, **options: str) -> Sink:
    """Frames that already have a text ``value`` column, at least once."""
    return Sink("kafka", {"kafka.bootstrap.servers": servers, "topic": topic, **options})


def json_sink(
    servers: str, topic: str, target: dict[str, str], key: str | None = None
) -> Sink:
    """Rows of the target schema as JSON records."""
    return Sink(
        "kafka",
        {"kafka.bootstrap.servers": servers, "topic": topic},
        prepare=lambda frame: record_frame(conform(frame, target), key),
    )
