"""Tumbling, sliding and session windows, and the join of two windowed streams.

A window aggregate is one shuffle: Spark aggregates inside each input task
first, so a plant that sends a third of all rows arrives at the shuffle as one row
per task and window, and a keyless window needs no more than that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = "w"
HEARTBEAT = "_heartbeat"


def tumble(
    frame: DataFrame,
    time: str | Column,
    size: str,
    measures: dict[str, Column],
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """Aggregate ``measures`` per key and half-open, epoch-aligned window.

    The window stays one struct column ``w``: its watermark is what lets Spark
    close a window, and later forget its state. Use ``bounds`` to spell it out at
    the very end. Measures take their final names here, because an output may
    differ from an input by case only.
    """
    return _measured(frame, F.window(time, size), measures, keys)


def slide(
    frame: DataFrame,
    time: str | Column,
    size: str,
    step: str,
    measures: dict[str, Column],
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """As ``tumble``, for windows of ``size`` that begin every ``step``.

    A row belongs to size / step windows and is copied to each within its input task;
    what is shuffled is one partial sum per task, key and window, as for ``tumble``.
    """
    return _measured(frame, F.window(time, size, step), measures, keys)


def sessions(
    frame: DataFrame,
    time: str | Column,
    gap: str | Column,
    measures: dict[str, Column],
    keys: tuple[str, ...],
) -> DataFrame:
    """As ``tumble``, for windows of a key's rows less than ``gap`` apart.

    ``w`` reaches from the first row to ``gap`` after the last. A row exactly ``gap``
    after another begins a new session. As a stream, a late row within the watermark may
    join two sessions of the state. The sessions of one key are merged in one task, after
    those of each input task have been merged there where Spark is set so.
    """
    return _measured(frame, F.session_window(time, gap), measures, keys)


def _measured(
    frame: DataFrame, window: Column, measures: dict[str, Column], keys: tuple[str, ...]
) -> DataFrame:
    grouped = frame.groupBy(*keys, window.alias(WINDOW))
    named = [measure.alias(name) for name, measure in measures.items()]
    if HEARTBEAT not in frame.columns:
        return grouped.agg(*named)
    rows = F.count_if(~F.col(HEARTBEAT)).alias("_rows")
    return grouped.agg(*named, rows).where("_rows > 0").drop("_rows")


def bounds(windowed: DataFrame) -> DataFrame:
    """Replace ``w`` by window_start and window_end, in the same place."""
    columns: list[Column] = []
    for name in windowed.columns:
        if name == WINDOW:
            columns.append(F.col(f"{WINDOW}.start").alias("window_start"))
            columns.append(F.col(f"{WINDOW}.end").alias("window_end"))
        else:
            columns.append(F.col(f"`{name}`"))
    return windowed.select(*columns)


def join_windows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join of two keyless window aggregates, one row per common window.

    The key is the window struct, not its start. Both aggregates are already
    split by it, so the join adds no shuffle; and as a stream it carries the
    watermark, so joined windows leave the state.
    """
    return left.join(right, WINDOW)
