"""Time columns: text, epoch milliseconds and wall clock to TIMESTAMP."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms of event time on the joined feeds and of messages.
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]XXX"


def event_time(column: str | Column, fmt: str = EVENT_TIME_FORMAT) -> Column:
    """Text to TIMESTAMP; text of another shape gives null, never an error."""
    return F.try_to_timestamp(_col(column), F.lit(fmt))


def iso_time(column: str | Column) -> Column:
    """ISO-8601 date, time and offset to TIMESTAMP, with or without a fraction.

    Text of another shape gives null, also a date or a time alone.
    """
    return F.try_to_timestamp(_col(column), F.lit(ISO_FORMAT))


def millis_time(column: str | Column) -> Column:
    """Epoch milliseconds to TIMESTAMP."""
    return F.timestamp_millis(_col(column))


def processing_time() -> Column:
    """Wall clock. In a stream it has one value per micro-batch."""
    return F.current_timestamp()


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
