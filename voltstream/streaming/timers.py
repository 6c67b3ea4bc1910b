"""Clock windows that close by a timer, without rows that stand for the time.

The second form of ``with_processing_time(heartbeat=True)`` and ``tumble``. A key keeps one
running sum per open window, and a processing-time timer at the window's end emits it,
also if its source has fallen silent: no extra source, no watermark, and a window of a
silent source holds back no other.

Rows of a key meet in one Python task, where the other form sums them up beforehand and
in generated code. Its throughput is the lower, and a key with a third of all rows is
one task's work: take it where sources are many and slow.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from voltstream.functions.measures import checked

UNITS, COUNT = "_units", "_count"


class ClockWindows(StatefulProcessor):
    """Sums and counts of whole units per key and window of ``width`` milliseconds."""

    def __init__(self, keys: tuple[str, ...], measures: tuple[str, ...], width: int):
        self.keys, self.measures, self.width = keys, measures, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        fields = [T.StructField("rows", T.LongType())]
        for name in self.measures:
            fields += [T.StructField(f"{name}{UNITS}", T.LongType()), T.StructField(f"{name}{COUNT}", T.LongType())]
        self._columns = [f.name for f in fields]
        end = T.StructType([T.StructField("end", T.LongType())])
        self._windows = handle.getMapState("windows", end, T.StructType(fields))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        end = (now // self.width + 1) * self.width
        added = [0] * len(self._columns)
        for frame in rows:
            found = [len(frame)]
            for name in self.measures:
                units = frame[f"{name}{UNITS}"].dropna()
                found += [int(units.astype("int64").sum()), len(units)]
            added = [a + b for a, b in zip(added, found, strict=True)]
        if self._windows.containsKey((end,)):
            before = self._windows.getValue((end,))
            added = [a + int(b) for a, b in zip(added, before, strict=True)]
        else:
            self._handle.registerTimer(end)
        self._windows.updateValue((end,), tuple(added))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        if self._windows.containsKey((end,)):
            sums = self._windows.getValue((end,))
            self._windows.removeKey((end,))
            row = {**dict(zip(self.keys, key)), "end": end, **dict(zip(self._columns, map(int, sums)))}
            yield pd.DataFrame([row])

    def close(self) -> None:
        pass


def timed_windows(
    frame: DataFrame, size_seconds: int, measures: tuple[str, ...], keys: tuple[str, ...], scale: int
) -> DataFrame:
    """Per key and clock window: window_start, window_end, rows, and sum and count of measures.

    ``frame`` is a stream. The readings are whole numbers of 10^-scale, so sums are
    exact; one that does not fit fails the job, a null counts as a row only. A measure
    comes out as ``<name>`` (its sum, DOUBLE) and ``<name>_count``. Needs an interval
    trigger and RocksDB state, which ``start`` sets.
    """
    units = [
        F.rint(checked(F.col(name), scale) * F.lit(10.0**scale)).cast("bigint").alias(f"{name}{UNITS}") for name in measures
    ]
    shaped = frame.select(*keys, *units)
    fields = [frame.schema[k] for k in keys] + [T.StructField("end", T.LongType()), T.StructField("rows", T.LongType())]
    for name in measures:
        fields += [T.StructField(f"{name}{UNITS}", T.LongType()), T.StructField(f"{name}{COUNT}", T.LongType())]
    windows = shaped.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=ClockWindows(keys, measures, size_seconds * 1000),
        outputStructType=T.StructType(fields),
        outputMode="append",
        timeMode="ProcessingTime",
    )
    columns: list[Column] = []
    for name in measures:
        columns += [(F.col(f"{name}{UNITS}") / F.lit(10.0**scale)).alias(name), F.col(f"{name}{COUNT}").alias(f"{name}_count")]
    return windows.select(
        *keys,
        F.timestamp_millis(F.col("end") - size_seconds * 1000).alias("window_start"),
        F.timestamp_millis("end").alias("window_end"),
        "rows",
        *columns,
    )
