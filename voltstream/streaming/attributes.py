"""Time attributes of a stream: which column windows run on, and how late it may be."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltstream.functions.records import LATE, NO_TIME, REASON
from voltstream.functions.times import event_time, processing_time
from voltstream.operators.windows import HEARTBEAT


def with_event_time(
    frame: DataFrame,
    source: str | Column = "Fecha",
    name: str = "ts_ltz",
    delay: str = "1 minute",
    strict: bool = True,
) -> DataFrame:
    """Add event time from text and tolerate rows up to ``delay`` out of order.

    Pass a Column for times that are not text. A row without a readable time belongs
    to no window: it fails the job, or leaves with ``split_event_time`` before, or is
    left out silently if ``strict`` is off. On a batch frame the watermark has no
    effect, so the same call serves both.
    """
    if not isinstance(source, str):
        return frame.withColumn(name, source).withWatermark(name, delay)
    value = event_time(source)
    if strict:
        shown = F.coalesce(F.col(source), F.lit("null"))
        problem = F.raise_error(F.concat(F.lit("unreadable event time: "), shown))
        value = F.coalesce(value, problem.cast("timestamp"))
    return _behind_barrier(frame, name, value).withWatermark(name, delay)


def split_event_time(
    frame: DataFrame, source: str = "Fecha"
) -> tuple[DataFrame, DataFrame]:
    """(rows with a readable time, the others); every input row is in one of the two."""
    readable = event_time(source).isNotNull()
    return frame.where(readable), frame.where(~readable)


def tag_event_time(tagged: DataFrame, source: str = "Fecha", name: str = "ts_ltz") -> DataFrame:
    """Add event time to ``tagged_records``; a record without a readable one is rejected."""
    timed = _behind_barrier(tagged, name, event_time(source))
    return _with_reason(timed, F.col(name).isNull(), NO_TIME)


def tag_late(
    tagged: DataFrame, name: str, size: str, delay: str, newest: int | None
) -> DataFrame:
    """Reject records whose window of ``size`` ended ``delay`` before ``newest``.

    ``newest`` is in microseconds since the epoch; without it nothing is late.
    """
    if newest is None:
        return tagged
    width, watermark = _micros(size), newest - _micros(delay)
    # Not ``F.window``: it would take rows without a time out.
    ended = (F.floor(F.unix_micros(name) / F.lit(width)) + 1) * F.lit(width) <= F.lit(watermark)
    return _with_reason(tagged, ended, LATE)


def _micros(interval: str) -> int:
    """Text like ``10 minutes`` in microseconds."""
    number, unit = interval.split()
    return timedelta(**{f"{unit.rstrip('s')}s": int(number)}) // timedelta(microseconds=1)


def _with_reason(tagged: DataFrame, condition: Column, reason: str) -> DataFrame:
    return tagged.withColumn(REASON, F.coalesce(F.col(REASON), F.when(condition, F.lit(reason))))


def _behind_barrier(frame: DataFrame, name: str, value: Column) -> DataFrame:
    # A filter on the result stays above this generator, so the text is parsed once.
    others = [F.col(f"`{c}`") for c in frame.columns if c != name]
    return frame.select(*others, F.inline(F.array(F.struct(value.alias(name)))))


def with_processing_time(
    frame: DataFrame, name: str = "proctime", heartbeat: bool = False
) -> DataFrame:
    """Add the wall clock as a time attribute.

    All rows of a micro-batch share one value, so keep the trigger interval well
    below the window size. A window closes when a batch arrives after its end; with
    ``heartbeat`` an extra row per second sees to that even if the source falls
    silent, and ``tumble`` leaves those rows out of its result. A replay after a
    failure lands in later windows: where that matters, run the window on event
    time or on the broker's arrival time instead.
    """
    if heartbeat and frame.isStreaming:
        frame = _with_beats(frame)
    return frame.withColumn(name, processing_time()).withWatermark(name, "0 seconds")


def _with_beats(frame: DataFrame) -> DataFrame:
    clock = frame.sparkSession.readStream.format("rate")
    beats = clock.options(rowsPerSecond=1, numPartitions=1).load()
    return frame.withColumn(HEARTBEAT, F.lit(False)).unionByName(
        beats.select(F.lit(True).alias(HEARTBEAT)), allowMissingColumns=True
    )
