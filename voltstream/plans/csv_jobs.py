"""Jobs on CSV: telemetry filters, and hourly readings through a row function."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltstream.operators.rows import device_stats
from voltstream.sinks.base import Sink

# Fixed value: compared as text, like every telemetry column.
WARM = "20"


def warm_readings(telemetry: DataFrame, least: str = WARM) -> DataFrame:
    """ts, device and temp where temp, as text, sorts at or after ``least``.

    The order is that of text: '9.5' passes a bound of '20' and '100' does not.
    Tables and streams.
    """
    return telemetry.where(F.col("temp") >= F.lit(least)).select("ts", "device", "temp")


def warmest_readings(
    telemetry: DataFrame, rows: int = 20, ties: tuple[str, ...] = ()
) -> DataFrame:
    """The warm readings that sort last by temp, again as text.

    ``ties`` names columns that decide among equal temps; without them any of
    the tied rows may come out.
    """
    return warm_readings(telemetry).orderBy(F.desc("temp"), *ties).limit(rows)


def warmest_readings_sql(
    telemetry: DataFrame, rows: int = 20, least: str = WARM
) -> DataFrame:
    """``warmest_readings`` in SQL."""
    return telemetry.sparkSession.sql(
        """
        SELECT ts, device, temp FROM {telemetry}
        WHERE temp >= :least ORDER BY temp DESC LIMIT :rows
        """,
        args={"least": least, "rows": rows},
        telemetry=telemetry,
    )


def some_readings(telemetry: DataFrame, rows: int = 10) -> DataFrame:
    """Any ``rows`` readings, all columns."""
    return telemetry.limit(rows)


def devices(telemetry: DataFrame) -> DataFrame:
    """Every device once."""
    return telemetry.select("device").distinct()


def hourly_to_stats(hourly: DataFrame, sink: Sink) -> DataFrame:
    """Compute each device's hourly statistics, write them, and return the frame."""
    stats = device_stats(hourly)
    sink.write(stats)
    return stats
