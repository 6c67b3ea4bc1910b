import json
import math
from datetime import datetime

import pytest

from voltstream.operators.messages import (
    alert_messages,
    alert_rows,
    normalise,
    parse_message,
    split_corrupt,
)
from voltstream.schemas import ALERT_ROW, RAW_ROW

STAMP = "2024-05-01T10:01:02.000345+00:00"
TIME = datetime(2024, 5, 1, 10, 1, 2, 345)


def text(radiacion, potencia, planta_id=7, timestamp=STAMP):
    return json.dumps(
        {
            "message_id": "m",
            "planta_id": planta_id,
            "message": {"Radiacion": radiacion, "Potencia": potencia},
            "timestamp": timestamp,
        }
    )


def values(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


@pytest.mark.parametrize(
    "radiacion, potencia, alerts",
    [
        (200.0, 10.0, False),
        (200.01, 49.99, True),
        (900.0, 50.0, False),
        (0.0, 0.0, False),
        (1250, 0, True),
        (None, 10.0, False),
        (900.0, None, False),
        (math.nan, 10.0, False),
        (900.0, math.nan, False),
    ],
)
def test_alert_bounds(spark, radiacion, potencia, alerts):
    readings = parse_message(values(spark, text(radiacion, potencia)))
    assert alert_rows(readings).count() == alerts


@pytest.mark.parametrize("bad", ["not json", "", "[1]", "{}", '{"message": 5}', None])
def test_bad_text_never_alerts(spark, bad):
    assert alert_messages(parse_message(values(spark, bad))).count() == 0


def test_bad_text_fails_a_strict_parse(spark):
    with pytest.raises(Exception, match="MALFORMED"):
        parse_message(values(spark, "not json"), strict=True).collect()


def test_alert_row(spark):
    rows = alert_rows(parse_message(values(spark, text(200.5, 49.5))))
    assert dict(rows.dtypes) == ALERT_ROW
    assert list(map(tuple, rows.collect())) == [(TIME, 7, 200.5, 49.5, "Sin Generacion")]


def test_alert_message(spark):
    ((value,),) = alert_messages(parse_message(values(spark, text(200.5, 49.5)))).collect()
    assert list(json.loads(value).items()) == [
        ("message_id", "m"),
        ("planta_id", 7),
        ("Radiacion", 200.5),
        ("Potencia", 49.5),
        ("alert", "Sin Generacion"),
        ("timestamp", STAMP),
    ]


def test_alert_bounds_are_parameters(spark):
    readings = parse_message(values(spark, text(150.0, 60.0)))
    assert alert_rows(readings, min_radiacion=100.0, max_potencia=70.0).count() == 1


@pytest.mark.parametrize("planta_id", [7, "7", 7.0])
def test_raw_row(spark, planta_id):
    rows = normalise(values(spark, text(1.5, 2.0, planta_id)))
    assert dict(rows.dtypes) == RAW_ROW
    ((message_id, plant, message, timestamp),) = rows.collect()
    assert (message_id, plant, timestamp) == ("m", 7, TIME)
    assert json.loads(message) == {"Radiacion": 1.5, "Potencia": 2.0}


def test_raw_message_keeps_unknown_fields(spark):
    value = json.dumps({"planta_id": 1, "message": {"a": {"b": [1, "x"]}}})
    ((message,),) = normalise(values(spark, value)).select("message").collect()
    assert json.loads(message) == {"a": {"b": [1, "x"]}}


def test_split_corrupt_loses_nothing(spark):
    frame = values(spark, text(1.0, 2.0), "no", '{"planta_id": 7, "mess', "{}")
    good, bad = split_corrupt(frame)
    assert good.count() == 2
    assert {r.value for r in bad.collect()} == {"no", '{"planta_id": 7, "mess'}
