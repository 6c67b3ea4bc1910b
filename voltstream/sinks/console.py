"""Printing. What is printed on the driver is a preview; whole results go to a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from voltstream.functions.records import json_text
from voltstream.sinks.base import Sink


def console_sink(preview: int = 20) -> Sink:
    """Print every row, on the executor that holds it, and a preview on the driver.

    A row is one JSON line in its executor's log. Nothing but the preview reaches the
    driver.
    """

    def show(frame: DataFrame, batch_id: int | None) -> None:
        frame.select(json_text(frame).alias("value")).foreachPartition(_print_all)
        frame.show(preview, truncate=False)

    return Sink("console", native=False, custom_write=show)


def preview_sink(rows: int = 20) -> Sink:
    """Print the first ``rows`` of every micro-batch on the driver, beside another sink."""

    def show(frame: DataFrame, batch_id: int | None) -> None:
        frame.show(rows, truncate=False)

    return Sink("preview", native=False, custom_write=show)


def describe(frame: DataFrame, rows: int = 20) -> None:
    """Print a frame's schema and, unless it is a stream, a preview of its rows."""
    frame.printSchema()
    if not frame.isStreaming:
        frame.show(rows, truncate=False)


def _print_all(rows) -> None:
    import sys

    # The worker's standard output belongs to Spark's protocol.
    for row in rows:
        print(row.value, file=sys.stderr)
