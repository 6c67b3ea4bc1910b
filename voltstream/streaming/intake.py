"""Records of a stream set apart before state: good ones to a table, others to rejects.

A stateful query has one output, so a text it cannot use either fails it or vanishes. An
intake is a stream of its own in front: it parses every text once, sends what is no record,
has no readable time or is too late to the rejects with the reason, and writes the
others to a table in the checkpoint's folder, which the stateful stream reads.

A batch of the table appears as a whole, by one rename, and a replay of the batch finds it
there: every accepted record is in the table exactly once. Files that the stateful
stream is done with are deleted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from voltstream.functions.records import LATE, NO_TIME, NOT_JSON, REASON, accepted, rejected, tagged_records
from voltstream.sinks.base import Sink
from voltstream.streaming.attributes import tag_event_time, tag_late
from voltstream.streaming.commitlog import CommitLog
from voltstream.streaming.run import start

STEP = "taken"


@dataclass(frozen=True)
class Lateness:
    """When a record is late: its window of ``size`` ended ``delay`` before the newest row.

    The newest row of the batches before counts, as for a watermark. What an intake
    accepts, no window behind it drops: that one's watermark never runs ahead of this.
    """

    size: str
    delay: str = "1 minute"


@dataclass(frozen=True)
class Intake:
    """``records`` is the stream of accepted records, ``query`` the intake that feeds it."""

    records: DataFrame
    query: StreamingQuery
    folder: str

    def account(self) -> dict[str, int]:
        """How many texts were accepted, and rejected for which reason, so far."""
        log = _log(self.records, self.folder)
        facts = log.last(STEP, 1 << 62) or {}
        return {name: int(facts.get(name, 0)) for name in ("accepted", NOT_JSON, NO_TIME, LATE)}


def take_in(
    values: DataFrame,
    schema: str,
    folder: str,
    rejects: Sink,
    fields: tuple[str, ...] | None = None,
    time: str | None = None,
    late: Lateness | None = None,
    name: str | None = None,
    every: str | None = None,
    to_end: bool = False,
    column: str = "value",
) -> Intake:
    """Start an intake of JSON texts into ``folder`` and give the records it accepts.

    ``time`` names a text field with the event time; the records then have it, typed, as
    ``ts_ltz``, and those without a readable one are rejected. ``late`` rejects records
    that no window would take. The rejects get (value, reason) rows.

    With ``to_end`` the intake has ended when this returns, so that a stateful stream run
    to its end sees all records.
    """
    spark = values.sparkSession
    log = _log(values, folder)

    def tagged(frame: DataFrame, batch_id: int) -> DataFrame:
        found = tagged_records(frame, schema, column, fields)
        if time is not None:
            found = tag_event_time(found, time)
        if late is not None:
            before = log.last(STEP, batch_id)
            newest = before and before.get("newest")
            found = tag_late(found, "ts_ltz", late.size, late.delay, newest)
        return found

    def take(frame: DataFrame, batch_id: int | None) -> None:
        if log.has(STEP, batch_id):
            return
        found = tagged(frame, batch_id)
        found.persist()
        try:
            _publish(accepted(found), folder, batch_id)
            if not log.has("rejects", batch_id):
                rejects.write(rejected(found), batch_id)
                log.add("rejects", batch_id)
            log.add(STEP, batch_id, _account(found, log.last(STEP, batch_id) or {}))
        finally:
            found.unpersist()

    sink = Sink("intake", native=False, custom_write=take)
    # The rows of a batch are known by its schema alone; no text is read for it.
    schema_of = accepted(tagged(spark.createDataFrame([], values.schema), 0)).schema
    query = start(values, sink, f"{folder}/checkpoint", name, every=every, to_end=to_end)
    if to_end:
        query.awaitTermination()
    _path(spark, _table(folder)).getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(_path(spark, _table(folder)))
    reader = spark.readStream.schema(_nullable(schema_of)).option("recursiveFileLookup", "true")
    return Intake(reader.option("cleanSource", "delete").parquet(_table(folder)), query, folder)


def _account(found: DataFrame, before: dict[str, object]) -> dict[str, object]:
    """Totals with the batch's rows added, and the newest event time in microseconds."""
    counts = [F.count_if(F.col(REASON).isNull()).alias("accepted")]
    counts += [F.count_if(F.col(REASON) == reason).alias(reason) for reason in (NOT_JSON, NO_TIME, LATE)]
    if "ts_ltz" in found.columns:
        newest = F.max(F.when(F.col(REASON).isNull(), F.unix_micros("ts_ltz")))
        counts.append(newest.alias("newest"))
    row = found.agg(*counts).first().asDict()
    times = [t for t in (row.pop("newest", None), before.get("newest")) if t is not None]
    totals = {name: int(before.get(name, 0)) + n for name, n in row.items()}
    return {**totals, "newest": max(times, default=None)}


def _publish(frame: DataFrame, folder: str, batch_id: int) -> None:
    """Write a batch's records beside the table and move them in at once, or find them there."""
    spark = frame.sparkSession
    draft, target = f"{folder}/_draft-{batch_id}", f"{_table(folder)}/batch-{batch_id}"
    files = _path(spark, target).getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(_path(spark, target)):
        return
    frame.write.mode("overwrite").parquet(draft)
    files.mkdirs(_path(spark, _table(folder)))
    if not files.rename(_path(spark, draft), _path(spark, target)):
        raise OSError(f"cannot move records to {target}")


def _log(frame: DataFrame, folder: str) -> CommitLog:
    return CommitLog(frame.sparkSession, f"{folder}/log")


def _table(folder: str) -> str:
    return f"{folder}/accepted"


def _path(spark, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
