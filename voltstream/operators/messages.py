"""Plant messages: parsing, the alert rule and the raw normal form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltstream.functions.records import (
    TEXT,
    accepted,
    conform,
    json_text,
    read_record,
    rejected,
    tagged_records,
)
from voltstream.functions.times import iso_time
from voltstream.schemas import (
    ALERT_MESSAGE,
    ALERT_ROW,
    PLANT_MESSAGE,
    RAW_MESSAGE,
    RAW_ROW,
)

# The alert rule.
MIN_RADIACION = 200.0
MAX_POTENCIA = 50.0
ALERT_TEXT = "Sin Generacion"


def parse_message(values: DataFrame, strict: bool = False) -> DataFrame:
    """JSON text in ``value`` to message_id, planta_id, Radiacion, Potencia, timestamp."""
    return message_fields(read_record(values, PLANT_MESSAGE, strict=strict))


def message_fields(records: DataFrame) -> DataFrame:
    """Records of a plant message, however they were read, to the columns above."""
    return records.select(
        "message_id",
        _whole_number("planta_id"),
        "message.Radiacion",
        "message.Potencia",
        "timestamp",
    )


def is_alert(
    radiacion: str | Column = "Radiacion",
    potencia: str | Column = "Potencia",
    min_radiacion: float = MIN_RADIACION,
    max_potencia: float = MAX_POTENCIA,
) -> Column:
    """Sun but no output: both bounds strict; null and NaN readings never alert.

    Spark orders NaN above every number, hence the explicit test.
    """
    sun = F.col(radiacion) if isinstance(radiacion, str) else radiacion
    output = F.col(potencia) if isinstance(potencia, str) else potencia
    return (sun > min_radiacion) & ~F.isnan(sun) & (output < max_potencia)


def alert_messages(readings: DataFrame, **bounds: float) -> DataFrame:
    """Alerting readings as JSON text, one ``value`` column."""
    return json_values(alert_records(readings, **bounds))


def alert_records(readings: DataFrame, **bounds: float) -> DataFrame:
    """Alerting readings with the fields of the alert message."""
    hits = readings.where(is_alert(**bounds)).withColumn("alert", F.lit(ALERT_TEXT))
    return conform(hits, ALERT_MESSAGE)


def alert_rows(readings: DataFrame, **bounds: float) -> DataFrame:
    """Alerting readings as typed rows."""
    hits = readings.where(is_alert(**bounds)).withColumn("Alerta", F.lit(ALERT_TEXT))
    return conform(hits.withColumn("timestamp", iso_time("timestamp")), ALERT_ROW)


def normalise(values: DataFrame, strict: bool = False) -> DataFrame:
    """JSON text to (message_id, planta_id, message, timestamp).

    ``message`` stays JSON text, whatever fields it has.
    """
    return raw_rows(read_record(values, RAW_MESSAGE, strict=strict))


def raw_rows(records: DataFrame) -> DataFrame:
    """Records of a raw message, however they were read, in their normal form."""
    typed = records.withColumns(
        {"planta_id": _whole_number("planta_id"), "timestamp": iso_time("timestamp")}
    )
    return conform(typed, RAW_ROW)


def split_corrupt(values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(normalised rows, text that is not JSON); every input row is in one of the two.

    Each half parses a text once. Where both are run, take them from one kept frame of
    ``tagged_records``, as the jobs do.
    """
    tagged = tagged_records(values, RAW_MESSAGE)
    return raw_rows(accepted(tagged)), rejected(tagged).select("value")


def split_values(
    values: DataFrame, schema: str = PLANT_MESSAGE
) -> tuple[DataFrame, DataFrame]:
    """(text that is JSON of the schema, other text), both in ``value``; null text is bad."""
    tagged = tagged_records(values, schema)
    good = tagged.where("_reason IS NULL").select(F.col(TEXT).alias("value"))
    return good, rejected(tagged).select("value")


def json_values(frame: DataFrame) -> DataFrame:
    """Every row as JSON text in one ``value`` column."""
    return frame.select(json_text(frame).alias("value"))


def _whole_number(name: str) -> Column:
    # Through DOUBLE, so that 7, 7.0 and "7" all give 7.
    return F.col(name).try_cast("double").try_cast("int").alias(name)
