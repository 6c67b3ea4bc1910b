"""The end of bounded input: a last row far ahead on every side of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltstream.streaming.workdir import fresh_dir

# Beyond every event time. Its own window never ends, so it comes out nowhere.
FAR = "9999-12-30 00:00:00"


class EndOfInput:
    """Closes the event-time windows of bounded streams, on all their sides.

    A window comes out once the watermark has passed it, and the watermark follows the
    newest rows: after the last row of a bounded input nothing moves it, and with several
    sides the slowest one holds it. ``mark`` adds to a side a source that is empty
    while the input is read. ``run_to_end(frame, flush=end)`` then puts one row into each
    and goes on: all watermarks move ahead and every window is emitted, once.

    The row has the time and nulls. Do not filter it out: Spark moves filters below
    the watermark, which then would not see it.

    For input that ends. Rows that arrive in a later run of the checkpoint would be late.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._sides: list[tuple[str, T.StructType, str]] = []

    def mark(self, frame: DataFrame, time: str) -> DataFrame:
        """The stream with its end marked; call it before the watermark is set.

        ``time`` is the column the event time comes from: a timestamp, text of the form
        of ``event_time``, or epoch milliseconds. A batch frame is returned as it is.
        """
        if not frame.isStreaming:
            return frame
        folder = fresh_dir(self._spark, "closing")
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in frame.schema.fields])
        self._spark.createDataFrame([], schema).write.parquet(folder)
        self._sides.append((folder, schema, time))
        return frame.unionByName(self._spark.readStream.schema(schema).parquet(folder))

    def close(self) -> None:
        """Put the last row into every side."""
        for folder, schema, time in self._sides:
            kind = schema[time].dataType
            far = F.unix_millis(F.lit(FAR).cast("timestamp")) if isinstance(kind, T.LongType) else F.lit(FAR)
            columns = (
                (far.cast(f.dataType) if f.name == time else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in schema.fields
            )
            self._spark.range(1).select(*columns).coalesce(1).write.mode("append").parquet(folder)
