"""Starting streams and running them to their end."""

from __future__ import annotations

import logging
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from voltstream.session import COUNT_STATE, PARTITIONS, PROVIDER, STATE_STORE, sized_partitions
from voltstream.sinks.base import Sink
from voltstream.sinks.files import BATCH_ID, parquet_sink
from voltstream.streaming.closing import EndOfInput
from voltstream.streaming.late import LateRows
from voltstream.streaming.workdir import fresh_dir

log = logging.getLogger(__name__)


def start(
    frame: DataFrame,
    sink: Sink,
    checkpoint: str,
    name: str | None = None,
    mode: str = "append",
    every: str | None = None,
    to_end: bool = False,
    partitions: int | None = None,
    count_state: bool = True,
) -> StreamingQuery:
    """Start one stream into one sink (see ``fan_out`` for several).

    ``every`` sets the trigger interval; ``to_end`` processes what is there and
    stops. ``checkpoint`` is required: with it a restart, or the loss of the
    driver, resumes at the offsets last committed.

    A sink with several parts keeps a log in the checkpoint, so that a batch which
    failed at one of them is not given again to the others.

    ``partitions`` is the number of state partitions, which a checkpoint keeps for
    its life. Without it the session's shuffle partitions hold, and if that is open
    too, the cluster's cores decide, with a warning.

    ``count_state=False`` leaves the number of state rows out of the progress, for streams
    whose progress nobody reads: each write to the state then needs one look-up less.
    """
    writer = sink.attach(frame, f"{checkpoint}/sinks").outputMode(mode)
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if to_end:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    with _stream_settings(frame.sparkSession, partitions, count_state):
        return writer.start()


def run_to_end(
    frame: DataFrame, mode: str = "append", flush: tuple[str, ...] | EndOfInput | None = None
) -> DataFrame:
    """Run a bounded stream to its end and return what it emitted, as a table.

    In append mode the windows still open at the end are not emitted. ``flush`` brings
    out all of them, each once, as a bounded input would close them: give it the
    ``EndOfInput`` that marked the sources, for windows joined or aggregated in any way,
    or the keys of a single windowed aggregate.

    The output is a Parquet table in the shared folder; no row passes through the
    driver. In update mode a window may be emitted more than once: the table then
    has a ``batch_id`` column, and ``latest`` picks the last state.
    """
    if isinstance(flush, tuple):
        return latest(run_to_end(frame, mode="update"), flush)
    spark = frame.sparkSession
    out = fresh_dir(spark, "emitted")
    sink = parquet_sink(out, native=mode == "append")
    checkpoint = fresh_dir(spark, "checkpoint")
    if flush is None:
        start(frame, sink, checkpoint, mode=mode, to_end=True, count_state=False).awaitTermination()
    else:
        # One run, before and after the end: a second one would have to load the state
        # again, and replay every change log since its last snapshot.
        query = start(frame, sink, checkpoint, mode=mode, count_state=False)
        try:
            query.processAllAvailable()
            flush.close()
            query.processAllAvailable()
        finally:
            query.stop()
    schema = frame.schema
    if mode != "append":
        # So that the table exists even if the stream had no batch.
        sink.write(spark.createDataFrame([], schema), batch_id=-1)
        schema = T.StructType([*schema.fields, T.StructField(BATCH_ID, T.LongType())])
    return spark.read.schema(schema).parquet(out)


def wait_for(*queries: StreamingQuery, late: LateRows | None = None) -> None:
    """Until all streams of a job have ended; if one fails, the others are stopped.

    With ``late`` the job also ends, by an error, when a stream is over its limit.
    """
    waiting = list(queries)
    try:
        while waiting:
            waiting = [query for query in waiting if not query.awaitTermination(1)]
            if late is not None:
                late.check()
        if late is not None:
            for query in queries:
                late.settle(query)
            late.check()
    finally:
        for query in queries:
            query.stop()


def latest(emitted: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The last state of every key in the output of an update-mode stream."""
    values = [c for c in emitted.columns if c not in (*keys, BATCH_ID)]
    last = F.max_by(F.struct(*values), BATCH_ID).alias("_last")
    return emitted.groupBy(*keys).agg(last).select(*keys, "_last.*")


@contextmanager
def _stream_settings(
    spark: SparkSession, partitions: int | None = None, count_state: bool = True
) -> Iterator[None]:
    # A stream copies the session's settings when it starts, so ours need to hold
    # for that moment only. What the session sets itself stays: a state store
    # provider, whether it counts its rows, or a number of partitions.
    settings = {} if spark.conf.get(PROVIDER, None) else dict(STATE_STORE)
    if not count_state and not spark.conf.get(COUNT_STATE, None):
        settings[COUNT_STATE] = "false"
    if partitions:
        settings[PARTITIONS] = str(partitions)
    elif not spark.conf.get(PARTITIONS, None):
        settings[PARTITIONS] = str(sized_partitions(spark))
        log.warning(
            "the checkpoint will keep %s state partitions, sized by the cores now"
            " registered; pass partitions= to choose",
            settings[PARTITIONS],
        )
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
