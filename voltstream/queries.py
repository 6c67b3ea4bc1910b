"""The package's operators on the driver's tables.

``events`` stands in for telemetry: its user or type is the device or plant, its
value one reading and ``props.k`` another. Where an operator reads JSON records or
CSV, Spark first derives them from the whole table. Every result has plain UTC
timestamps, and the name of a query is the key of its SQL in ``voltstream.oracle``.
"""

from __future__ import annotations

import json
from argparse import Namespace
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltstream.functions.measures import mean, total
from voltstream.functions.records import REASON, TEXT, conform, read_record, tagged_records
from voltstream.functions.times import millis_time
from voltstream.operators.messages import (
    alert_messages,
    alert_rows,
    json_values,
    normalise,
    parse_message,
)
from voltstream.operators.rows import (
    device_stats,
    device_stats_batches,
    device_stats_row,
    map_rows,
)
from voltstream.operators.windows import bounds, sessions, slide, tumble
from voltstream.plans.csv_jobs import (
    devices,
    hourly_to_stats,
    some_readings,
    warm_readings,
    warmest_readings,
    warmest_readings_sql,
)
from voltstream.plans.windowed import (
    device_charge,
    device_charge_sql,
    joined_means,
    joined_means_sql,
    paired_means,
    plant_means,
)
from voltstream.schemas import (
    ALERT_MESSAGE,
    DEVICE_CHARGE,
    DEVICE_READING,
    DEVICE_STATS,
    HOURLY,
    INVERTER,
    IRRADIANCE,
    JOINED_WINDOW,
    PLANT_READING,
    RAW_MESSAGE,
    TELEMETRY,
    ddl,
)
from voltstream.session import ship_package, use_utc
from voltstream.sinks.base import fan_out
from voltstream.sinks.files import csv_sink, json_folder, parquet_sink
from voltstream.sinks.kafka import record_frame
from voltstream.sources.files import csv_table, named_table, parquet_table
from voltstream.streaming.attributes import (
    split_event_time,
    with_event_time,
    with_processing_time,
)
from voltstream.streaming.closing import EndOfInput
from voltstream.streaming.intake import Lateness, take_in
from voltstream.streaming.run import latest, run_to_end, start
from voltstream.streaming.workdir import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]

EVENTS = (
    "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING"
)
ORDERS = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
    "o_totalprice DOUBLE, o_orderdate TIMESTAMP, o_orderpriority STRING"
)
READINGS = (
    "l_orderkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE"
)

# The alert bounds that suit the value ranges of events.
BOUNDS = {"min_radiacion": 100.0, "max_potencia": 50.0}
# Readings in events carry two decimals.
SCALE = 2


# ---- Views of the tables as telemetry --------------------------------------


def events(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    return parquet_table(spark, f"{sf_dir}/events.parquet", EVENTS, stream)


def order_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = parquet_table(spark, f"{sf_dir}/orders.parquet", ORDERS)
    return orders.select(
        F.col("o_orderkey").cast("string").alias("ts"),
        F.col("o_custkey").cast("string").alias("device"),
        F.col("o_orderpriority").alias("temp"),
    )


def event_telemetry(frame: DataFrame) -> DataFrame:
    """Events with the nine text columns of the telemetry CSV."""
    return frame.select(
        F.col("event_id").cast("string").alias("ts"),
        F.col("user_id").cast("string").alias("device"),
        _k().cast("string").alias("co"),
        F.col("event_type").alias("humidity"),
        F.lit("false").alias("light"),
        F.col("props").alias("lpg"),
        F.lit("true").alias("motion"),
        F.lit("0.02").alias("smoke"),
        F.col("value").cast("string").alias("temp"),
    )


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as hourly readings: four doubles per key."""
    items = parquet_table(spark, f"{sf_dir}/lineitem.parquet", READINGS)
    return items.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("device_id"),
        F.col("l_quantity").alias("min15"),
        F.col("l_extendedprice").alias("min30"),
        F.col("l_discount").alias("min45"),
        F.col("l_tax").alias("min60"),
    )


def message_values(frame: DataFrame, *beside: str) -> DataFrame:
    """Events as nested plant messages in JSON, and columns that stay beside them."""
    measures = F.struct(
        F.col("value").alias("Radiacion"), _k().cast("double").alias("Potencia")
    )
    message = F.struct(
        F.col("event_id").cast("string").alias("message_id"),
        F.col("user_id").cast("int").alias("planta_id"),
        measures.alias("message"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("timestamp"),
    )
    return frame.select(F.to_json(message, {"ignoreNullFields": "false"}).alias("value"), *beside)


def typed_readings(frame: DataFrame) -> DataFrame:
    """Events with the columns of a parsed plant message."""
    return read_record(frame, "k INT", column="props").select(
        F.col("event_id").cast("string").alias("message_id"),
        F.col("user_id").cast("int").alias("planta_id"),
        F.col("value").alias("Radiacion"),
        F.col("k").cast("double").alias("Potencia"),
        F.col("ts").alias("timestamp"),
    )


def plant_readings(frame: DataFrame) -> DataFrame:
    """Events with the columns of a flat plant reading, plus ``ts``."""
    return frame.select(
        F.col("event_type").alias("planta_id"),
        F.col("value").alias("potencia"),
        _k().cast("double").alias("radiacion"),
        F.unix_millis("ts").alias("time_ts"),
        "ts",
    )


def device_readings(frame: DataFrame) -> DataFrame:
    """Events with the columns of a device reading, clock time in ``proctime``."""
    return frame.select(
        F.col("user_id").cast("string").alias("device_id"),
        F.lit(0.004).alias("co"),
        _k().cast("double").alias("humidity"),
        (F.col("event_type") == "click").alias("motion"),
        F.lit(20.0).alias("temp"),
        F.col("value").alias("ampere_hour"),
        F.unix_millis("ts").alias("ts"),
        F.col("ts").alias("proctime"),
    )


def feed(frame: DataFrame, kind: str, measure: str) -> DataFrame:
    """The events of one type as a feed of the window join, event time in ``ts_ltz``."""
    return frame.where(F.col("event_type") == kind).select(
        F.col("value").alias(measure), F.col("ts").alias("ts_ltz")
    )


def feed_values(frame: DataFrame, kind: str, measure: str) -> DataFrame:
    """The same feed as JSON records with text time."""
    return json_values(
        frame.where(F.col("event_type") == kind).select(
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Fecha"),
            F.col("value").alias(measure),
        )
    )


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


# ---- Rows, filters, top-k ---------------------------------------------------


def select_where_string(spark, sf_dir):
    return warm_readings(order_telemetry(spark, sf_dir), "2")


def limit(spark, sf_dir):
    return some_readings(events(spark, sf_dir).orderBy("event_id"))


def distinct(spark, sf_dir):
    frame = events(spark, sf_dir)
    return devices(frame.select(F.col("user_id").cast("string").alias("device")))


def topk_string(spark, sf_dir):
    return warmest_readings(order_telemetry(spark, sf_dir), ties=("ts", "device"))


def topk_string_sql(spark, sf_dir):
    # Which of the rows with equal temp come out is open, their temps are not.
    return warmest_readings_sql(event_telemetry(events(spark, sf_dir))).select("temp")


def csv_roundtrip(spark, sf_dir):
    path = fresh_dir(spark, "events-csv")
    csv_sink(path).write(events(spark, sf_dir))
    return csv_table(spark, path, EVENTS)


def csv_text_roundtrip(spark, sf_dir):
    """Texts with line breaks, quotes and blanks at the ends, empty and missing ones."""
    path = fresh_dir(spark, "texts-csv")
    texts = parquet_table(spark, f"{sf_dir}/documents.parquet", "doc_id BIGINT, text STRING")
    kind = F.col("doc_id") % 10
    changed = F.when(kind == 0, F.lit("")).when(kind == 1, F.lit(None))
    changed = changed.when(kind == 2, F.concat(F.lit(r'  "\n\r'), "text", F.lit('", ')))
    frame = texts.withColumn("text", changed.otherwise(F.col("text")))
    csv_sink(path, escape_breaks=True).write(frame)
    return csv_table(spark, path, "doc_id BIGINT, text STRING", escape_breaks=True)


def csv_filter_job(spark, sf_dir):
    """The job ``csv-filter`` on a folder of CSV, and all it wrote."""
    from voltstream.cli import JOBS

    source, target = fresh_dir(spark, "telemetry-csv"), fresh_dir(spark, "warm")
    csv_sink(source).write(event_telemetry(events(spark, sf_dir)))
    args = Namespace(
        job="csv-filter", input=source, output=target, checkpoint=fresh_dir(spark, "checkpoint")
    )
    JOBS["csv-filter"](spark, args).awaitTermination()
    schema = "ts STRING, device STRING, temp STRING"
    return spark.read.schema(schema).option("recursiveFileLookup", "true").json(target)


def named_devices(spark, sf_dir):
    events(spark, sf_dir).createOrReplaceTempView("telemetry_events")
    frame = named_table(spark, "telemetry_events")
    return devices(frame.select(F.col("user_id").cast("string").alias("device")))


# ---- Messages ---------------------------------------------------------------


def alert_rows_typed(spark, sf_dir):
    return alert_rows(typed_readings(events(spark, sf_dir)), **BOUNDS)


def alert_json(spark, sf_dir):
    readings = parse_message(message_values(events(spark, sf_dir)))
    return read_record(alert_messages(readings, **BOUNDS), ddl(ALERT_MESSAGE))


def raw_normalise(spark, sf_dir):
    return normalise(message_values(events(spark, sf_dir)))


def raw_rejects(spark, sf_dir):
    """Messages of which every seventh is cut short: rows and rejects from one parse."""
    frame = events(spark, sf_dir)
    cut = F.when(F.col("event_id") % 7 == 0, F.substring("value", 1, 40)).otherwise(F.col("value"))
    tagged = tagged_records(message_values(frame, "event_id").select(cut.alias("value")), RAW_MESSAGE)
    good = F.col(REASON).isNull()
    return tagged.select(
        F.when(good, F.col("message_id")).alias("message_id"),
        good.alias("accepted"),
        F.when(~good, F.col(TEXT)).alias("value"),
    )


def bad_event_times(spark, sf_dir):
    """Event times of which every fifth is a text that is none: both parts together."""
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    frame = events(spark, sf_dir).select(
        "event_id", F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("T"), stamp)).otherwise(stamp).alias("Fecha")
    )
    good, bad = split_event_time(frame)
    timed = with_event_time(good).select("event_id", "ts_ltz")
    return timed.unionByName(bad.select("event_id", F.lit(None).cast("timestamp").alias("ts_ltz")))


def kafka_record_roundtrip(spark, sf_dir):
    charge = device_charge(device_readings(events(spark, sf_dir)), scale=SCALE)
    records = record_frame(conform(charge, DEVICE_CHARGE), key="device_id")
    return read_record(records, ddl(DEVICE_CHARGE))


# ---- Windows and the window join --------------------------------------------


def type_means(frame: DataFrame) -> DataFrame:
    """Ten-minute mean per event type."""
    measures = {"mean_value": mean("value", 1, SCALE)}
    return bounds(tumble(frame, "ts", "10 minutes", measures, keys=("event_type",)))


def tumble10_keyed_avg(spark, sf_dir):
    return type_means(events(spark, sf_dir))


def tumble60_keyed_avg(spark, sf_dir):
    return plant_means(plant_readings(events(spark, sf_dir)), "ts", scale=SCALE)


def plant_json_means(spark, sf_dir):
    wire = json_values(plant_readings(events(spark, sf_dir)).drop("ts"))
    readings = with_event_time(
        read_record(wire, PLANT_READING), millis_time("time_ts"), "event_time"
    )
    return plant_means(readings, "event_time", scale=SCALE)


def tumble30_sum_sql(spark, sf_dir):
    # Decimal readings, so that SQL's plain sum is exact.
    readings = device_readings(events(spark, sf_dir)).withColumn(
        "ampere_hour", F.col("ampere_hour").cast("decimal(18,2)")
    )
    return conform(device_charge_sql(readings), DEVICE_CHARGE)


def tumble30_sum_df(spark, sf_dir):
    return device_charge(device_readings(events(spark, sf_dir)), scale=SCALE)


def device_json_charge(spark, sf_dir):
    wire = json_values(device_readings(events(spark, sf_dir)).drop("proctime"))
    readings = with_event_time(
        read_record(wire, DEVICE_READING), millis_time("ts"), "event_time"
    )
    return device_charge(readings, "event_time", scale=SCALE)


def window_join(spark, sf_dir):
    frame = events(spark, sf_dir)
    return joined_means(
        feed(frame, "click", "Radiacion"), feed(frame, "view", "PA_Inv"), scale=SCALE
    )


def window_join_one_scan(spark, sf_dir):
    frame = events(spark, sf_dir).withColumnRenamed("ts", "ts_ltz")
    sides = (
        F.when(F.col("event_type") == kind, F.col("value")) for kind in ("click", "view")
    )
    wanted = frame.where(F.col("event_type").isin("click", "view"))
    return paired_means(wanted, *sides, scale=SCALE)


def window_join_json_sql(spark, sf_dir):
    frame = events(spark, sf_dir)
    sun = read_record(feed_values(frame, "click", "Radiacion"), IRRADIANCE)
    power = read_record(feed_values(frame, "view", "PA_Inv"), INVERTER)
    return joined_means_sql(with_event_time(sun), with_event_time(power))


def window_join_views(spark, sf_dir):
    """The published sub-queries of the window join, read by name and joined anew."""
    frame = events(spark, sf_dir).withColumn("value", F.col("value").cast("decimal(18,2)"))
    sides = feed(frame, "click", "Radiacion"), feed(frame, "view", "PA_Inv")
    joined_means_sql(*sides, views=("sun_means", "power_means"))
    left, right = (named_table(spark, name) for name in ("sun_means", "power_means"))
    return conform(bounds(left.join(right, "w")), JOINED_WINDOW)


# ---- Row functions ------------------------------------------------------------


def row_function(spark, sf_dir):
    return device_stats(hourly(spark, sf_dir))


def row_function_batches(spark, sf_dir):
    return device_stats_batches(hourly(spark, sf_dir))


def row_function_rows(spark, sf_dir):
    return map_rows(hourly(spark, sf_dir), device_stats_row, ddl(DEVICE_STATS))


def user_function(spark, sf_dir):
    """A loop per row that ends by its data, which no column function has."""
    columns = events(spark, sf_dir).select("event_id", "props")
    return map_rows(columns, _common_divisor, "event_id BIGINT, divisor BIGINT", drop_none=True)


def _common_divisor(row: Row) -> tuple[int, int] | None:
    divisor, rest = row.event_id, json.loads(row.props)["k"]
    while rest:
        divisor, rest = rest, divisor % rest
    return (row.event_id, divisor) if divisor > 1 else None


def hourly_csv(spark, sf_dir):
    source, target = fresh_dir(spark, "hourly-csv"), fresh_dir(spark, "stats-csv")
    csv_sink(source).write(hourly(spark, sf_dir))
    hourly_to_stats(csv_table(spark, source, HOURLY), csv_sink(target))
    return csv_table(spark, target, ddl(DEVICE_STATS))


# ---- Streams ------------------------------------------------------------------


def stream_tumble(spark, sf_dir):
    source = with_event_time(events(spark, sf_dir, stream=True), F.col("ts"), "ts")
    return run_to_end(type_means(source))


def in_batches(spark, sf_dir, parts: int = 4, files: int = 2) -> DataFrame:
    """Events as a stream of several batches in order of time, of so many files each.

    One pass deals the events to parts. A last part, an hour after the rest, has one event
    of each type: it closes every window before it and stays open itself.
    """
    path, frame = fresh_dir(spark, "event-files"), events(spark, sf_dir)
    second = F.col("ts").cast("double")
    low, high = frame.agg(F.min(second), F.max(second)).first()
    part = F.least(F.floor((second - low) * parts / (high - low)), F.lit(parts - 1)).cast("int")
    types = frame.groupBy("event_type").agg(F.max("value").alias("value"))
    end = F.timestamp_seconds(F.lit(high)) + F.expr("INTERVAL 1 HOUR")
    closing = types.withColumns({"ts": end, "part": F.lit(parts)})
    dealt = frame.withColumn("part", part).unionByName(closing, allowMissingColumns=True)
    staged = fresh_dir(spark, "event-parts")
    dealt.write.partitionBy("part").parquet(staged)
    for n in range(parts + 1):
        # Files are taken in the order they were written in.
        one = spark.read.schema(EVENTS).parquet(f"{staged}/part={n}")
        one.repartition(files).write.mode("append").parquet(path)
    return parquet_table(spark, path, EVENTS, stream=True, maxFilesPerTrigger=str(files))


def stream_tumble_batches(spark, sf_dir):
    source = with_event_time(in_batches(spark, sf_dir), F.col("ts"), "ts")
    return run_to_end(type_means(source))


def stream_tumble_flushed(spark, sf_dir):
    source = with_event_time(events(spark, sf_dir, stream=True), F.col("ts"), "ts")
    keys = ("event_type", "window_start", "window_end")
    return run_to_end(type_means(source), flush=keys)


def stream_window_join_batches(spark, sf_dir):
    source = in_batches(spark, sf_dir)
    sun, power = (
        with_event_time(feed(source, kind, measure), F.col("ts_ltz"))
        for kind, measure in (("click", "Radiacion"), ("view", "PA_Inv"))
    )
    return run_to_end(joined_means(sun, power, scale=SCALE))


def stream_window_join(spark, sf_dir):
    source = events(spark, sf_dir, stream=True)
    sun, power = (
        with_event_time(feed(source, kind, measure), F.col("ts_ltz"))
        for kind, measure in (("click", "Radiacion"), ("view", "PA_Inv"))
    )
    return run_to_end(joined_means(sun, power, scale=SCALE))


def stream_window_join_flushed(spark, sf_dir):
    """All windows of the join, from plain tables: both sides are closed at their end."""
    source, end = events(spark, sf_dir, stream=True), EndOfInput(spark)
    sun, power = (
        with_event_time(end.mark(feed(source, kind, measure), "ts_ltz"), F.col("ts_ltz"))
        for kind, measure in (("click", "Radiacion"), ("view", "PA_Inv"))
    )
    return run_to_end(joined_means(sun, power, scale=SCALE), flush=end)


def rejected_texts(spark: SparkSession, folder: str) -> DataFrame:
    reader = spark.read.schema("value STRING, reason STRING")
    return reader.option("recursiveFileLookup", "true").json(folder)


def stream_dead_letters(spark, sf_dir):
    """Records of which every fifth is no JSON or has no time: windows and rejects.

    The counts of both together are those of all events.
    """
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    kind = F.col("event_id") % 10
    record = F.to_json(F.struct(F.when(kind == 5, F.concat(F.lit("T"), stamp)).otherwise(stamp).alias("Fecha"), "value"))
    texts = events(spark, sf_dir, stream=True).select(
        F.when(kind == 0, F.substring(record, 1, 20)).otherwise(record).alias("value")
    )
    folder = fresh_dir(spark, "rejects")
    taken = take_in(
        texts,
        "Fecha STRING, value DOUBLE",
        fresh_dir(spark, "intake"),
        json_folder(folder, native=False),
        time="Fecha",
        to_end=True,
    )
    end = EndOfInput(spark)
    records = with_event_time(end.mark(taken.records, "ts_ltz"), F.col("ts_ltz"))
    measures = {"n": F.count("*"), "total": total("value", SCALE)}
    windows = run_to_end(bounds(tumble(records, "ts_ltz", "10 minutes", measures)), flush=end)
    rejects = rejected_texts(spark, folder).groupBy("reason").agg(F.count("*").alias("n"))
    return windows.drop("window_end").unionByName(rejects, allowMissingColumns=True)


def stream_late_records(spark, sf_dir):
    """Four quarters of the events, the last one second: windows, and late records one by one.

    A quarter is a batch of its own: the intake stops and resumes between them, so a batch
    may have any number of files, and each is taken in on all cores.
    """
    path, frame = fresh_dir(spark, "event-quarters"), events(spark, sf_dir)
    quarter = frame.agg(F.max("event_id") + 1).first()[0] / 4
    folder, intake, files = fresh_dir(spark, "rejects"), fresh_dir(spark, "intake"), spark.sparkContext.defaultParallelism
    for n in (0, 3, 2, 1):
        part = frame.where(F.floor(F.col("event_id") / F.lit(quarter)) == n)
        part.repartition(files).write.mode("append").parquet(path)
        texts = parquet_table(spark, path, EVENTS, stream=True).select(
            F.to_json(F.struct("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Fecha"))).alias("value")
        )
        taken = take_in(
            texts,
            "event_id BIGINT, Fecha STRING",
            intake,
            json_folder(folder, native=False),
            time="Fecha",
            late=Lateness("10 minutes", "1 minute"),
            to_end=True,
        )
    end = EndOfInput(spark)
    records = with_event_time(end.mark(taken.records, "ts_ltz"), F.col("ts_ltz"))
    windows = run_to_end(bounds(tumble(records, "ts_ltz", "10 minutes", {"n": F.count("*")})), flush=end)
    late = rejected_texts(spark, folder).select("reason", F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"))
    return windows.drop("window_end").unionByName(late, allowMissingColumns=True)


def sliding_means(frame: DataFrame) -> DataFrame:
    """Hourly means per event type, every ten minutes."""
    measures = {"mean_value": mean("value", 1, SCALE), "n": F.count("*")}
    return bounds(slide(frame, "ts", "60 minutes", "10 minutes", measures, keys=("event_type",)))


def sliding(spark, sf_dir):
    return sliding_means(events(spark, sf_dir))


def stream_sliding(spark, sf_dir):
    end = EndOfInput(spark)
    source = with_event_time(end.mark(events(spark, sf_dir, stream=True), "ts"), F.col("ts"), "ts")
    return run_to_end(sliding_means(source), flush=end)


def user_sessions(frame: DataFrame) -> DataFrame:
    """A user's events with less than half an hour between them, as one visit."""
    measures = {"n": F.count("*"), "total": total("value", SCALE)}
    return bounds(sessions(frame, "ts", "30 minutes", measures, keys=("user_id",)))


def batch_sessions(spark, sf_dir):
    return user_sessions(events(spark, sf_dir))


def stream_sessions(spark, sf_dir):
    """The same visits from a stream in batches: one that goes on is merged in the state."""
    source = in_batches(spark, sf_dir)
    newest = events(spark, sf_dir).agg(F.max("event_id")).first()[0]
    end = EndOfInput(spark)
    real = end.mark(source.where(F.col("event_id") <= newest), "ts")
    return run_to_end(user_sessions(with_event_time(real, F.col("ts"), "ts")), flush=end)


def stream_alerts(spark, sf_dir):
    readings = parse_message(message_values(events(spark, sf_dir, stream=True)))
    return run_to_end(alert_rows(readings, **BOUNDS))


def stream_fan_out(spark, sf_dir):
    """Alerts of a stream written to two sinks at once, read back from both."""
    readings = typed_readings(events(spark, sf_dir, stream=True))
    alerts = alert_rows(readings, **BOUNDS)
    as_csv, as_parquet = fresh_dir(spark, "alerts-csv"), fresh_dir(spark, "alerts")
    both = fan_out(csv_sink(as_csv), parquet_sink(as_parquet))
    start(alerts, both, fresh_dir(spark, "checkpoint"), to_end=True).awaitTermination()
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in alerts.schema)
    nested = {"recursiveFileLookup": "true"}
    return (
        csv_table(spark, as_csv, schema, **nested)
        .withColumn("sink", F.lit("csv"))
        .unionByName(
            parquet_table(spark, as_parquet, schema, **nested).withColumn(
                "sink", F.lit("parquet")
            )
        )
    )


def stream_csv_filter(spark, sf_dir):
    path = fresh_dir(spark, "telemetry-csv")
    csv_sink(path).write(event_telemetry(events(spark, sf_dir)))
    return run_to_end(warm_readings(csv_table(spark, path, TELEMETRY, stream=True)))


def stream_clock_tumble(spark, sf_dir):
    """Wall-clock windows, summed up per type: the windows themselves vary by run."""
    source = with_processing_time(events(spark, sf_dir, stream=True))
    measures = {"total": total("value", SCALE)}
    windowed = tumble(source, "proctime", "60 seconds", measures, keys=("event_type",))
    emitted = run_to_end(bounds(windowed), mode="update")
    windows = latest(emitted, ("event_type", "window_start", "window_end"))
    return windows.groupBy("event_type").agg(total("total", SCALE).alias("total"))


# ---- Registration ---------------------------------------------------------------

QUERIES: dict[str, Query] = {
    "q01_select_where_string": select_where_string,
    "q02_limit": limit,
    "q03_distinct": distinct,
    "q04_topk_string": topk_string,
    "q04_topk_string_sql": topk_string_sql,
    "q05_csv_roundtrip": csv_roundtrip,
    "q05_csv_text_roundtrip": csv_text_roundtrip,
    "q06_alert_rows": alert_rows_typed,
    "q07_alert_json": alert_json,
    "q08_raw_normalise": raw_normalise,
    "q08_raw_rejects": raw_rejects,
    "q08_bad_event_times": bad_event_times,
    "q09_tumble60_keyed_avg": tumble60_keyed_avg,
    "q09_plant_json_means": plant_json_means,
    "q10_tumble30_sum_sql": tumble30_sum_sql,
    "q11_tumble30_sum_df": tumble30_sum_df,
    "q11_device_json_charge": device_json_charge,
    "q12_window_join": window_join,
    "q12_window_join_one_scan": window_join_one_scan,
    "q12_window_join_json_sql": window_join_json_sql,
    "q12_window_join_views": window_join_views,
    "q13_row_function": row_function,
    "q13_row_function_batches": row_function_batches,
    "q13_row_function_rows": row_function_rows,
    "q13_user_function": user_function,
    "q13_hourly_csv": hourly_csv,
    "q14_tumble10_keyed_avg": tumble10_keyed_avg,
    "q14_stream_tumble": stream_tumble,
    "q14_stream_tumble_batches": stream_tumble_batches,
    "q14_stream_tumble_flushed": stream_tumble_flushed,
    "q15_stream_window_join": stream_window_join,
    "q15_stream_window_join_batches": stream_window_join_batches,
    "q15_stream_window_join_flushed": stream_window_join_flushed,
    "q16_stream_alerts": stream_alerts,
    "q17_stream_fan_out": stream_fan_out,
    "q18_stream_clock_tumble": stream_clock_tumble,
    "q19_stream_csv_filter": stream_csv_filter,
    "q20_kafka_record_roundtrip": kafka_record_roundtrip,
    "q21_csv_filter_job": csv_filter_job,
    "q22_named_devices": named_devices,
    "q23_stream_dead_letters": stream_dead_letters,
    "q24_stream_late_records": stream_late_records,
    "q25_sliding_mean": sliding,
    "q25_stream_sliding_mean": stream_sliding,
    "q26_sessions": batch_sessions,
    "q26_stream_sessions": stream_sessions,
}


def registered() -> dict[str, Query]:
    return {name: _plain(query) for name, query in QUERIES.items()}


def _plain(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        frame = query(ship_package(use_utc(spark)), sf_dir)
        return frame.select(
            *(
                F.col(f.name).cast("timestamp_ntz").alias(f.name)
                if isinstance(f.dataType, T.TimestampType)
                else F.col(f.name)
                for f in frame.schema.fields
            )
        )

    return run
