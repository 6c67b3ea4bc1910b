import pytest
from pyspark.sql import functions as F

from voltstream.plans.csv_jobs import (
    devices,
    hourly_to_stats,
    some_readings,
    warm_readings,
    warmest_readings,
    warmest_readings_sql,
)
from voltstream.queries import event_telemetry, events, hourly
from voltstream.schemas import DEVICE_STATS, TELEMETRY, ddl
from voltstream.sinks.files import csv_sink
from voltstream.sources.files import csv_table, named_table, parquet_table


@pytest.fixture(scope="module")
def telemetry(spark):
    temps = ["9.5", "20.1", "100", "temp", None, "20", "2"]
    rows = [(str(n), f"d{n % 2}", *["x"] * 6, temp) for n, temp in enumerate(temps)]
    return spark.createDataFrame(rows, TELEMETRY)


def test_temp_compares_as_text(telemetry):
    warm = warm_readings(telemetry)
    assert warm.columns == ["ts", "device", "temp"]
    assert {r.temp for r in warm.collect()} == {"temp", "9.5", "20.1", "20"}


@pytest.mark.parametrize("form", [warmest_readings, warmest_readings_sql])
def test_warmest_sort_as_text(telemetry, form):
    assert [r.temp for r in form(telemetry).collect()] == ["temp", "9.5", "20.1", "20"]


def test_warmest_ties(telemetry):
    twice = telemetry.union(telemetry.withColumn("ts", F.concat("ts", F.lit("'"))))
    top = warmest_readings(twice, rows=3, ties=("ts",)).collect()
    assert [(r.ts, r.temp) for r in top] == [("3", "temp"), ("3'", "temp"), ("0", "9.5")]


def test_limit_and_distinct(telemetry):
    assert some_readings(telemetry, 3).count() == 3
    assert some_readings(telemetry, 3).columns == telemetry.columns
    assert {r.device for r in devices(telemetry).collect()} == {"d0", "d1"}


def test_named_table(spark, telemetry):
    telemetry.createOrReplaceTempView("device_data")
    assert named_table(spark, "device_data").schema == telemetry.schema


def test_csv_keeps_quotes_microseconds_and_doubles(spark, tables, tmp_path):
    frame = events(spark, tables)
    csv_sink(str(tmp_path / "out")).write(frame)
    schema = ", ".join(f"{n} {t}" for n, t in frame.dtypes)
    back = csv_table(spark, str(tmp_path / "out"), schema)
    assert back.count() == frame.count()
    assert back.exceptAll(frame).count() == 0


def test_csv_doubles_quotes(spark, tmp_path):
    frame = spark.sql("""SELECT 'a "b", c' AS x, 1 AS y""")
    csv_sink(str(tmp_path / "out")).write(frame)
    (data,) = (tmp_path / "out").glob("*.csv")
    assert data.read_text() == '"a ""b"", c",1\n'


def test_misfit_field_fails_unless_asked_otherwise(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("a,1.5\nb,much\n")
    schema = "device STRING, x DOUBLE"
    with pytest.raises(Exception, match="MALFORMED"):
        csv_table(spark, str(tmp_path), schema).collect()
    lenient = csv_table(spark, str(tmp_path), schema, mode="PERMISSIVE")
    assert [tuple(r) for r in lenient.collect()] == [("a", 1.5), ("b", None)]


def test_hourly_job_writes_what_it_returns(spark, tables, tmp_path):
    stats = hourly_to_stats(hourly(spark, tables), csv_sink(str(tmp_path / "out")))
    back = csv_table(spark, str(tmp_path / "out"), ddl(DEVICE_STATS))
    assert back.count() == stats.count()
    assert back.exceptAll(stats).count() == 0


def test_declared_timestamp_reads_plain_times_as_utc(spark, tables):
    plain = spark.read.parquet(f"{tables}/events.parquet").select("ts")
    assert dict(plain.dtypes)["ts"] == "timestamp_ntz"
    declared = parquet_table(spark, f"{tables}/events.parquet", "ts TIMESTAMP")
    assert declared.collect() == plain.collect()


def test_telemetry_has_the_declared_columns(spark, tables):
    frame = event_telemetry(events(spark, tables))
    assert ", ".join(f"{n} {t.upper()}" for n, t in frame.dtypes) == TELEMETRY
