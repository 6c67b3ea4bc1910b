from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from voltstream.functions.measures import mean, total
from voltstream.operators.windows import bounds, join_windows, tumble
from voltstream.plans.windowed import (
    device_charge,
    device_charge_sql,
    joined_means,
    joined_means_sql,
    plant_means,
)
from voltstream.queries import device_readings, events, feed
from voltstream.streaming.attributes import split_event_time, with_event_time


def rows(frame):
    return sorted(map(tuple, frame.collect()))


def at(hour, minute, second=0, micro=0):
    return datetime(2024, 5, 1, hour, minute, second, micro)


def test_windows_are_half_open_and_aligned(spark):
    times = [at(10, 0), at(10, 9, 59, 999999), at(10, 10), None]
    frame = spark.createDataFrame([(t, 1.0) for t in times], "ts timestamp, x double")
    got = bounds(tumble(frame, "ts", "10 minutes", {"n": total("x")}))
    assert rows(got) == [(at(10, 0), at(10, 10), 2.0), (at(10, 10), at(10, 20), 1.0)]


def test_times_before_the_epoch(spark):
    frame = spark.createDataFrame([(datetime(1969, 12, 31, 23, 59, 59), 1.0)], "ts timestamp, x double")
    ((start, end, _),) = bounds(tumble(frame, "ts", "60 seconds", {"x": total("x")})).collect()
    assert (start, end) == (datetime(1969, 12, 31, 23, 59), datetime(1970, 1, 1))


def test_output_names_may_differ_from_inputs_by_case(spark):
    frame = spark.createDataFrame(
        [("Vara", 10.0, 500.0, at(10, 0, 1)), ("Vara", 11.0, 501.0, at(10, 0, 59)),
         ("Oliva", 1.234, 2.345, at(10, 1))],
        "planta_id string, potencia double, radiacion double, proctime timestamp",
    )
    means = plant_means(frame)
    assert means.columns == [
        "planta_id", "window_start", "window_end", "Potencia", "Radiacion",
    ]
    assert rows(means) == [
        ("Oliva", at(10, 1), at(10, 2), 1.23, 2.35),
        ("Vara", at(10, 0), at(10, 1), 10.5, 500.5),
    ]


def test_charge_against_brute_force(spark, tables):
    readings = device_readings(events(spark, tables))
    expected = defaultdict(int)
    for r in readings.select("device_id", "proctime", "ampere_hour").collect():
        start = r.proctime - timedelta(
            seconds=r.proctime.second % 30, microseconds=r.proctime.microsecond
        )
        expected[r.device_id, start] += round(r.ampere_hour * 100)
    got = rows(device_charge(readings, scale=2))
    assert got == sorted(
        (device, start, start + timedelta(seconds=30), units / 100)
        for (device, start), units in expected.items()
    )


def test_charge_in_sql_equals_charge_in_columns(spark, tables):
    readings = device_readings(events(spark, tables))
    twin = device_charge_sql(readings)
    assert twin.columns == device_charge(readings).columns
    assert rows(twin) == rows(device_charge(readings))


def test_hot_key_stays_whole(spark):
    """One device sends most rows, within one window, and is still counted exactly."""
    frame = spark.range(300_000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string")).alias("device_id"),
        F.lit(at(10, 0)).alias("proctime"),
        F.lit(0.01).alias("ampere_hour"),
    )
    charge = device_charge(frame, scale=2)
    assert charge.count() == 100_001
    ((hot,),) = charge.where("device_id = 'hot'").select("charge_consumed").collect()
    assert hot == 2000.0


def test_joined_windows_hand_case(spark):
    emi = spark.createDataFrame(
        [("2024-05-01 10:01:00", 100.0), ("2024-05-01 10:09:00", 101.0),
         ("2024-05-01 10:12:00", 5.0)],
        "Fecha string, Radiacion float",
    )
    inv = spark.createDataFrame(
        [("2024-05-01 10:05:00", 7.0), ("2024-05-01 10:25:00", 8.0)],
        "Fecha string, PA_Inv float",
    )
    expected = [(at(10, 0), at(10, 10), 100.5, 7.0)]
    for join in (joined_means, joined_means_sql):
        joined = join(with_event_time(emi), with_event_time(inv))
        assert rows(joined) == expected
        assert [kind for _, kind in joined.dtypes] == ["timestamp"] * 2 + ["float"] * 2


def test_unreadable_event_times_fail_or_leave(spark):
    frame = spark.createDataFrame(
        [("2024-05-01 10:01:00", 1.0), ("T10:01:00", 2.0), (None, 3.0)], "Fecha string, Radiacion float"
    )
    with pytest.raises(Exception, match="unreadable event time"):
        with_event_time(frame).collect()
    good, bad = split_event_time(frame)
    assert [r.Radiacion for r in with_event_time(good).collect()] == [1.0]
    assert sorted(r.Radiacion for r in bad.collect()) == [2.0, 3.0]
    assert with_event_time(frame, strict=False).where("ts_ltz IS NULL").count() == 2


def test_join_publishes_its_views(spark, tables):
    frame = events(spark, tables)
    pair = feed(frame, "click", "Radiacion"), feed(frame, "view", "PA_Inv")
    joined = joined_means_sql(*pair, views=("sun_means", "power_means"))
    assert rows(joined) == rows(joined_means(*pair))
    assert spark.table("sun_means").columns == ["w", "Radiacion"]
    assert spark.table("power_means").columns == ["w", "PA"]


def test_join_against_brute_force(spark, tables):
    frame = events(spark, tables)
    sides = {}
    for kind in ("click", "view"):
        groups = defaultdict(list)
        for r in frame.where(F.col("event_type") == kind).select("ts", "value").collect():
            start = r.ts.replace(minute=r.ts.minute // 10 * 10, second=0, microsecond=0)
            groups[start].append(round(r.value * 100))
        sides[kind] = groups
    common = sides["click"].keys() & sides["view"].keys()
    left, right = (
        tumble(
            frame.where(F.col("event_type") == kind), "ts", "10 minutes",
            {name: mean("value", scale=2)},
        )
        for kind, name in (("click", "a"), ("view", "b"))
    )
    got = rows(bounds(join_windows(left, right)))
    assert [r[0] for r in got] == sorted(common)
    for start, _, a, b in got:
        for value, units in ((a, sides["click"][start]), (b, sides["view"][start])):
            assert value == sum(units) / 100 / len(units)
