"""The jobs by name, for ``spark-submit run_job.py <job>``.

Logins come from the environment (POSTGRES_DB, POSTGRES_USER, POSTGRES_PASSWORD,
MONGO_INITDB_ROOT_USERNAME, MONGO_INITDB_ROOT_PASSWORD), never from arguments.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voltstream.plans.alerts import (
    alerts_to_console,
    alerts_to_table,
    alerts_to_topic,
    raw_to_table,
)
from voltstream.plans.csv_jobs import (
    devices,
    hourly_to_stats,
    some_readings,
    warm_readings,
    warmest_readings,
)
from voltstream.plans.windowed import (
    device_charge,
    device_charge_sql,
    joined_means,
    joined_means_sql,
    plant_means,
)
from voltstream.schemas import (
    ALERT_TABLE,
    DEVICE_CHARGE,
    DEVICE_READING,
    GROUPS,
    HOURLY,
    INVERTER,
    IRRADIANCE,
    JOINED_WINDOW,
    MONGO_TARGET,
    PLANT_READING,
    PLANT_WINDOW,
    RAW_TABLE,
    TABLES,
    TELEMETRY,
    TOPICS,
)
from voltstream.session import get_spark, ship_package
from voltstream.sinks.base import Sink, fan_out
from voltstream.sinks.console import console_sink, describe, preview_sink
from voltstream.sinks.files import csv_sink, json_folder
from voltstream.sinks.jdbc import postgres_sink
from voltstream.sinks.kafka import json_sink, text_sink
from voltstream.sinks.mongo import mongo_sink, mongo_uri
from voltstream.sources.files import csv_table
from voltstream.sources.kafka import kafka_table, kafka_values
from voltstream.streaming.attributes import with_event_time, with_processing_time
from voltstream.streaming.intake import Lateness, take_in
from voltstream.streaming.late import LateRows
from voltstream.streaming.run import start, wait_for
from voltstream.streaming.workdir import job_dir

# A job's streams, the one with its result last; none for a batch job.
Started = StreamingQuery | tuple[StreamingQuery, ...] | None
Job = Callable[[SparkSession, argparse.Namespace], Started]

# The event-time windows of the joined feeds, whose late records an intake rejects.
JOIN_LATENESS = Lateness("10 minutes", "1 minute")
PLANT_KEY = ("planta_id", "window_start")
JOIN_KEY = ("window_start",)


def run(args: argparse.Namespace) -> dict[str, object]:
    return {"to_end": args.to_end, "partitions": args.partitions}


def windows(args: argparse.Namespace) -> dict[str, object]:
    """As ``run``, for clock windows. A run to the end emits those still open too, so a
    window may come again with a later run, then with more rows."""
    return {**run(args), "mode": "update" if args.to_end else "append"}


def limits(args: argparse.Namespace) -> dict[str, str]:
    """Bounds on a micro-batch and the split of full topic partitions."""
    given = {"maxOffsetsPerTrigger": args.max_offsets, "minPartitions": args.min_partitions}
    return {name: str(value) for name, value in given.items() if value}


def rejects(args: argparse.Namespace, feed: str | None = None) -> Sink | None:
    """The folder of rejected texts; a job of several feeds has one in it for each."""
    if not args.rejects:
        return None
    return json_folder(f"{args.rejects}/{feed}" if feed else args.rejects, native=False)


def relational(args: argparse.Namespace) -> dict[str, object]:
    """How a table is written, where the command line says so."""
    given = {"batch_column": args.batch_column, "connections": args.connections}
    return {name: value for name, value in given.items() if value}


def kept(args: argparse.Namespace) -> Sink:
    """All rows into the output folder, a preview on the console."""
    return fan_out(json_folder(args.output, native=False), preview_sink())


def messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    topic = "plant_messages"
    return kafka_values(
        spark,
        args.servers,
        TOPICS[topic],
        earliest=args.earliest,
        group=GROUPS[topic],
        **limits(args),
    )


Records = tuple[DataFrame, tuple[StreamingQuery, ...]]


def records(
    spark: SparkSession,
    args: argparse.Namespace,
    topic: str,
    schema: str,
    fields: tuple[str, ...] | None = None,
    time: str | None = None,
    late: Lateness | None = None,
) -> Records:
    """A topic's records, and the streams that run in front of them.

    With ``--rejects`` an intake sets bad texts apart before they reach any state, with
    ``time`` also those without a readable time, which then is in ``ts_ltz``. Otherwise
    a bad text fails the job.
    """
    source = {"group": GROUPS[topic], **limits(args)}
    if not args.rejects:
        table = kafka_table(
            spark, args.servers, TOPICS[topic], schema, fields=fields, strict=True, **source
        )
        return (with_event_time(table, time) if time else table), ()
    taken = take_in(
        kafka_values(spark, args.servers, TOPICS[topic], earliest=True, **source),
        schema,
        f"{args.checkpoint}/intake/{topic}",
        rejects(args, topic if time else None),
        fields,
        time,
        late,
        name=f"{args.job}-{topic}",
        to_end=args.to_end,
    )
    table = taken.records
    if time:
        table = with_event_time(table, F.col("ts_ltz"))
    return table, (taken.query,)


def feeds(spark: SparkSession, args: argparse.Namespace) -> tuple[Records, Records]:
    """The two joined feeds. A scaled reading is read as it was written, not as FLOAT."""
    kinds = {"irradiance": IRRADIANCE, "inverter": INVERTER}
    if args.scale is not None:
        kinds = {topic: schema.replace("FLOAT", "DOUBLE") for topic, schema in kinds.items()}
    sun, power = (
        records(spark, args, topic, schema, time="Fecha", late=JOIN_LATENESS)
        for topic, schema in kinds.items()
    )
    return sun, power


def _means(sink: Callable[[argparse.Namespace], Sink]) -> Job:
    def job(spark: SparkSession, args: argparse.Namespace) -> Started:
        fields = ("planta_id", "potencia", "radiacion")
        readings, intake = records(spark, args, "plant_readings", PLANT_READING, fields)
        clocked = with_processing_time(readings, heartbeat=True)
        means = plant_means(clocked, scale=args.scale)
        describe(readings)
        describe(means)
        return *intake, start(means, sink(args), args.checkpoint, args.job, **windows(args))

    return job


def _charge(transform: Callable[..., DataFrame]) -> Job:
    def job(spark: SparkSession, args: argparse.Namespace) -> Started:
        fields = ("device_id", "ampere_hour")
        readings, intake = records(spark, args, "device_readings", DEVICE_READING, fields)
        clocked = with_processing_time(readings, heartbeat=True)
        charge = transform(clocked, args.scale)
        topic = TOPICS["device_charge"]
        sink = json_sink(args.servers, topic, DEVICE_CHARGE, key="device_id")
        return *intake, start(charge, sink, args.checkpoint, args.job, **windows(args))

    return job


def _joined(
    transform: Callable[..., DataFrame], sink: Callable[[argparse.Namespace], Sink]
) -> Job:
    def job(spark: SparkSession, args: argparse.Namespace) -> Started:
        (sun, first), (power, second) = feeds(spark, args)
        joined = transform(sun, power, scale=args.scale)
        query = start(joined, sink(args), args.checkpoint, args.job, **run(args))
        return *first, *second, query

    return job


def _csv_filter(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    telemetry = csv_table(spark, args.input, TELEMETRY, stream=True)
    describe(telemetry)
    warm = warm_readings(telemetry)
    return start(warm, kept(args), args.checkpoint, args.job, to_end=True)


def _csv_report(spark: SparkSession, args: argparse.Namespace) -> None:
    telemetry = csv_table(spark, args.input, TELEMETRY)
    warmest = warmest_readings(telemetry)
    parts = {"some": some_readings(telemetry), "devices": devices(telemetry), "warmest": warmest}
    for name, frame in parts.items():
        json_folder(f"{args.output}/{name}").write(frame)
        describe(frame)
    warmest.explain("formatted")


def _csv_stats(spark: SparkSession, args: argparse.Namespace) -> None:
    hourly = csv_table(spark, args.input, HOURLY)
    describe(hourly)
    describe(hourly_to_stats(hourly, csv_sink(args.output)))


JOBS: dict[str, Job] = {
    "alerts-console": lambda spark, a: alerts_to_console(
        messages(spark, a),
        fan_out(console_sink(), json_folder(a.output, native=False)),
        a.checkpoint,
        rejects=rejects(a),
        **run(a),
    ),
    "alerts-kafka": lambda spark, a: alerts_to_topic(
        messages(spark, a),
        text_sink(a.servers, TOPICS["plant_alerts"]),
        a.checkpoint,
        rejects=rejects(a),
        **run(a),
    ),
    "alerts-postgres": lambda spark, a: alerts_to_table(
        messages(spark, a),
        postgres_sink(TABLES["alerts"], ALERT_TABLE, a.postgres, **relational(a)),
        a.checkpoint,
        rejects=rejects(a),
        **run(a),
    ),
    "raw-postgres": lambda spark, a: raw_to_table(
        messages(spark, a),
        postgres_sink(TABLES["raw"], RAW_TABLE, a.postgres, **relational(a)),
        a.checkpoint,
        rejects=rejects(a),
        **run(a),
    ),
    "means-console": _means(kept),
    "means-kafka": _means(
        lambda a: json_sink(a.servers, TOPICS["plant_window"], PLANT_WINDOW)
    ),
    "means-postgres": _means(
        lambda a: postgres_sink(
            TABLES["plant_window"], PLANT_WINDOW, a.postgres, key=PLANT_KEY, **relational(a)
        )
    ),
    "means-mongo": _means(
        lambda a: mongo_sink(
            mongo_uri(a.mongo), **MONGO_TARGET, target=PLANT_WINDOW, key=PLANT_KEY
        )
    ),
    "charge-kafka": _charge(lambda frame, scale: device_charge(frame, scale=scale)),
    "charge-kafka-sql": _charge(device_charge_sql),
    "joined-kafka": _joined(
        joined_means, lambda a: json_sink(a.servers, TOPICS["joined"], JOINED_WINDOW)
    ),
    "joined-postgres": _joined(
        joined_means_sql,
        lambda a: postgres_sink(
            TABLES["joined"], JOINED_WINDOW, a.postgres, key=JOIN_KEY, **relational(a)
        ),
    ),
    "csv-filter": _csv_filter,
    "csv-report": _csv_report,
    "csv-stats": _csv_stats,
}


# Flags that some jobs have no use for; those refuse them.
MESSAGE_JOBS = tuple(job for job in JOBS if job.startswith(("alerts-", "raw-")))
CLOCK_JOBS = tuple(job for job in JOBS if job.startswith(("means-", "charge-")))
JOINED_JOBS = tuple(job for job in JOBS if job.startswith("joined-"))
TABLE_JOBS = tuple(job for job in JOBS if job.endswith("-postgres"))
TAKEN_BY = {
    "rejects": (*MESSAGE_JOBS, *CLOCK_JOBS, *JOINED_JOBS),
    "scale": (*CLOCK_JOBS, *JOINED_JOBS),
    "late_limit": JOINED_JOBS,
    "batch_column": TABLE_JOBS,
    "connections": TABLE_JOBS,
}
DEFAULTS = {"rejects": None, "scale": 2, "late_limit": None, "batch_column": None, "connections": None}


def _scale(text: str) -> int | None:
    return None if text == "none" else int(text)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, argument_default=argparse.SUPPRESS)
    parser.add_argument("job", choices=JOBS)
    for name, meaning in (
        ("servers", "Kafka bootstrap servers"),
        ("postgres", "host:port of Postgres"),
        ("mongo", "host:port of MongoDB"),
        ("input", "CSV file or folder"),
        ("output", "folder for the whole result of jobs that print"),
        ("checkpoint", "default: per job, in the shared folder"),
    ):
        parser.add_argument(f"--{name}", default=None, help=meaning)
    for name, meaning in (
        ("max-offsets", "records per micro-batch"),
        ("min-partitions", "tasks that read a topic"),
        ("partitions", "state partitions of a stream"),
    ):
        parser.add_argument(f"--{name}", type=int, default=None, help=meaning)
    parser.add_argument("--rejects", help="folder for texts that are no records, with the reason")
    parser.add_argument("--scale", type=_scale, help="decimals of readings, or 'none'; default 2")
    parser.add_argument("--late-limit", type=int, help="late rows that end the job when exceeded")
    parser.add_argument("--batch-column", help="BIGINT column of the table for the batch number")
    parser.add_argument("--connections", type=int, help="tasks that write to the table at a time")
    parser.add_argument("--earliest", action="store_true", default=False, help="start of the topic")
    parser.add_argument("--to-end", action="store_true", default=False, help="stop when caught up")
    args = parser.parse_args(argv)
    for name, default in DEFAULTS.items():
        if name in args and args.job not in TAKEN_BY[name]:
            parser.error(f"{args.job} does not take --{name.replace('_', '-')}")
        setattr(args, name, getattr(args, name, default))

    spark = ship_package(get_spark(args.job))
    args.checkpoint = args.checkpoint or job_dir(spark, args.job)
    args.output = args.output or job_dir(spark, f"{args.job}-output")
    late = LateRows(args.late_limit)
    spark.streams.addListener(late)
    try:
        started = JOBS[args.job](spark, args)
        if started is not None:
            wait_for(*(started if isinstance(started, tuple) else (started,)), late=late)
    finally:
        spark.streams.removeListener(late)
