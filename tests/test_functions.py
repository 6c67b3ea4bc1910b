import math
import struct
from datetime import datetime
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from voltstream.functions.measures import mean, precise_sum, total
from voltstream.functions.records import (
    conform,
    json_text,
    read_record,
    read_record_checked,
)
from voltstream.functions.times import event_time, iso_time, millis_time


def one(frame):
    (row,) = frame.collect()
    return tuple(row)


def test_event_time_takes_its_format_only(spark):
    frame = spark.createDataFrame(
        [("2024-05-01 10:01:02",), ("2024-05-01T10:01:02Z",), ("soon",), (None,)],
        "Fecha string",
    )
    got = [r[0] for r in frame.select(event_time("Fecha")).collect()]
    assert got == [datetime(2024, 5, 1, 10, 1, 2), None, None, None]


@pytest.mark.parametrize(
    "text, micros",
    [
        ("2024-05-01T10:01:02.000345+00:00", 345),
        ("2024-05-01T10:01:02+00:00", 0),
        ("2024-05-01T12:01:02.5+02:00", 500000),
    ],
)
def test_iso_time_with_and_without_fraction(spark, text, micros):
    frame = spark.createDataFrame([(text,)], "t string").select(iso_time("t"))
    assert one(frame) == (datetime(2024, 5, 1, 10, 1, 2, micros),)


@pytest.mark.parametrize("text", ["2024", "10:30", "2024-05-01", "2024-05-01T10:01:02", "soon"])
def test_iso_time_takes_nothing_less(spark, text):
    frame = spark.createDataFrame([(text,)], "t string").select(iso_time("t"))
    assert one(frame) == (None,)


@pytest.mark.parametrize("scale, reading", [(2, 0.004), (2, math.nan), (None, math.nan), (None, math.inf)])
def test_a_reading_that_does_not_fit_fails(spark, scale, reading):
    frame = spark.createDataFrame([(1.0,), (reading,)], "x double")
    for measure in (total("x", scale), mean("x", 1, scale)):
        with pytest.raises(PySparkException, match="does not fit its scale"):
            frame.agg(measure).collect()


def test_millis_time(spark):
    frame = spark.createDataFrame([(1714557662345,)], "ts bigint")
    assert one(frame.select(millis_time("ts"))) == (
        datetime(2024, 5, 1, 10, 1, 2, 345000),
    )


def test_mean_rounds_half_up_on_the_exact_mean(spark):
    frame = spark.createDataFrame([(10.01,), (10.02,)], "x double")
    assert one(frame.agg(mean("x", 2, scale=2), mean("x", 2))) == (10.02, 10.02)


def test_measures_skip_nulls_and_empty_groups(spark):
    frame = spark.createDataFrame([(1.5,), (None,), (2.0,)], "x double")
    measures = [mean("x", scale=1), total("x", scale=1), mean("x"), total("x")]
    assert one(frame.agg(*measures)) == (1.75, 3.5, 1.75, 3.5)
    assert one(frame.where("x > 9").agg(*measures)) == (None,) * 4


def test_scaled_total_does_not_hang_on_partitioning(spark):
    frame = spark.range(20000).select((F.col("id") % 997 / 100).alias("x"))
    exact = float(sum(Fraction(n % 997, 100) for n in range(20000)))
    sums = {
        one(frame.repartition(n).agg(total("x", scale=2)))[0] for n in (1, 3, 7, 16)
    }
    assert sums == {exact}


def test_scaled_total_fails_rather_than_wraps(spark):
    frame = spark.createDataFrame([(9e16,), (9e16,)], "x double")
    with pytest.raises(PySparkException):
        frame.agg(total("x", scale=2)).collect()


reading = st.floats(0.0, 1e6, allow_subnormal=False).filter(lambda x: not 0 < x < 1e-6)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(reading, reading, reading, reading), min_size=50, max_size=200))
def test_precise_sum_is_the_nearest_double(spark, rows):
    frame = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = [r[0] for r in frame.select(precise_sum("a", "b", "c", "d")).collect()]
    assert list(map(bits, got)) == [bits(math.fsum(row)) for row in rows]


def test_precise_sum_of_special_values(spark):
    frame = spark.createDataFrame(
        [(math.inf, 1.0), (math.nan, 1.0), (None, 1.0)], "a double, b double"
    )
    first, second, third = (r[0] for r in frame.select(precise_sum("a", "b")).collect())
    assert first == math.inf and math.isnan(second) and third is None


def bits(x):
    return struct.pack("d", x)


def test_read_record_keeps_other_columns_and_nulls_misfits(spark):
    frame = spark.createDataFrame(
        [("a", '{"x": 1, "y": "u"}'), ("b", '{"x": "one"}'), ("c", "no"), ("d", None)],
        "key string, value string",
    )
    got = {tuple(r) for r in read_record(frame, "x INT, y STRING").collect()}
    assert got == {
        ("a", 1, "u"),
        ("b", None, None),
        ("c", None, None),
        ("d", None, None),
    }


def test_strict_record_fails_on_bad_text(spark):
    frame = spark.createDataFrame([("no",)], "value string")
    with pytest.raises(Exception, match="MALFORMED"):
        read_record(frame, "x INT", strict=True).collect()


def test_checked_record_keeps_the_bad_text(spark):
    frame = spark.createDataFrame([('{"x": 1}',), ('{"x": ',), ("no",)], "value string")
    got = read_record_checked(frame, "x INT").orderBy("x").collect()
    assert [tuple(r) for r in got] == [(None, '{"x": '), (None, "no"), (1, None)]


def test_json_text_writes_nulls_and_trims_times(spark):
    frame = spark.sql(
        "SELECT 1 AS a, CAST(NULL AS STRING) AS b, TIMESTAMP'2024-01-01 00:10:00' AS c,"
        " TIMESTAMP'2024-01-01 00:10:00.5' AS d"
    )
    assert one(frame.select(json_text(frame))) == (
        '{"a":1,"b":null,"c":"2024-01-01 00:10:00","d":"2024-01-01 00:10:00.5"}',
    )


def test_json_round_trip(spark):
    schema = "id INT, at TIMESTAMP, x DOUBLE, s STRING"
    rows = [
        (1, datetime(2024, 1, 1, 0, 10), 0.1, 'q"uote'),
        (2, datetime(2024, 1, 1, 0, 0, 0, 123456), None, None),
    ]
    frame = spark.createDataFrame(rows, schema)
    back = read_record(frame.select(json_text(frame).alias("value")), schema)
    assert sorted(tuple(r) for r in back.collect()) == rows


def test_conform_orders_and_casts(spark):
    frame = spark.sql("SELECT 1 AS extra, 2 AS b, '3' AS a")
    shaped = conform(frame, {"a": "int", "b": "string"})
    assert shaped.dtypes == [("a", "int"), ("b", "string")]
    assert one(shaped) == (3, "2")
