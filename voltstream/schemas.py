"""Declared schemas. Nothing in this package infers one.

Record schemas are DDL strings for ``spark.read.schema`` and ``from_json``.
Target schemas are ordered ``{column: type}`` maps; a sink casts to them.
"""

from __future__ import annotations

# ---- Fixed values: wire records -------------------------------------------

# Nested plant message. ``planta_id`` arrives as a number or as digits in a
# string, so it is read as text and cast by the parser.
PLANT_MESSAGE = (
    "message_id STRING, planta_id STRING, "
    "message STRUCT<Radiacion: DOUBLE, Potencia: DOUBLE>, timestamp STRING"
)
# The same message for the raw feed, which keeps ``message`` whole, as JSON text.
RAW_MESSAGE = (
    "message_id STRING, planta_id STRING, message STRING, timestamp STRING"
)

# Flat plant reading; time_ts is epoch milliseconds.
PLANT_READING = (
    "planta_id STRING, potencia DOUBLE, radiacion DOUBLE, time_ts BIGINT"
)

# Device reading, keyed by device; ts is epoch milliseconds.
DEVICE_READING = (
    "device_id STRING, co DOUBLE, humidity DOUBLE, motion BOOLEAN, "
    "temp DOUBLE, ampere_hour DOUBLE, ts BIGINT"
)

# The two event-time feeds of the window join; Fecha is local text time.
IRRADIANCE = "Fecha STRING, Radiacion FLOAT"
INVERTER = "Fecha STRING, PA_Inv FLOAT"

# Telemetry CSV, no header, every column text.
TELEMETRY = (
    "ts STRING, device STRING, co STRING, humidity STRING, light STRING, "
    "lpg STRING, motion STRING, smoke STRING, temp STRING"
)

# Hourly CSV: one device and its four quarter-hour readings.
HOURLY = (
    "device_id STRING, min15 DOUBLE, min30 DOUBLE, min45 DOUBLE, min60 DOUBLE"
)

# ---- Fixed values: targets ------------------------------------------------

ALERT_MESSAGE = {
    "message_id": "string",
    "planta_id": "int",
    "Radiacion": "double",
    "Potencia": "double",
    "alert": "string",
    "timestamp": "string",
}
RAW_ROW = {
    "message_id": "string",
    "planta_id": "int",
    "message": "string",
    "timestamp": "timestamp",
}
ALERT_ROW = {
    "timestamp": "timestamp",
    "planta_id": "int",
    "Radiacion": "float",
    "Potencia": "float",
    "Alerta": "string",
}
# The relational targets of those two rows declare every column varchar.
RAW_TABLE = {name: "string" for name in RAW_ROW}
ALERT_TABLE = {name: "string" for name in ALERT_ROW}

PLANT_WINDOW = {
    "planta_id": "string",
    "window_start": "timestamp",
    "window_end": "timestamp",
    "Potencia": "double",
    "Radiacion": "double",
}
JOINED_WINDOW = {
    "window_start": "timestamp",
    "window_end": "timestamp",
    "Radiacion": "float",
    "PA": "float",
}
DEVICE_CHARGE = {
    "device_id": "string",
    "window_start": "timestamp",
    "window_end": "timestamp",
    "charge_consumed": "double",
}
DEVICE_STATS = {
    "device_id": "string",
    "total_charge_consumed": "double",
    "avg_15": "double",
}

# ---- Fixed values: names on the outside ------------------------------------

TOPICS = {
    "plant_messages": "FV",
    "plant_alerts": "FV_alerts",
    "plant_readings": "fv_plantas",
    "plant_window": "fv_table",
    "device_readings": "sensor.readings",
    "device_charge": "device.charge",
    "irradiance": "FV_Pavasal_Cheste_EMI",
    "inverter": "FV_Pavasal_Cheste_Inv",
    "joined": "FV_Pavasal_Cheste_Final",
}
GROUPS = {
    "plant_messages": "iot-sensors",
    "plant_readings": "fv_group",
    "device_readings": "device.tumbling.w.sql",
    "irradiance": "test-group",
    "inverter": "test-group",
}
TABLES = {
    "raw": "raw_fv_data",
    "alerts": "alert_fv_data",
    "plant_window": "fv_table",
    "joined": "fv_pavasal_cheste",
}
MONGO_TARGET = {"database": "monitorizacion", "collection": "fv"}


def ddl(target: dict[str, str]) -> str:
    """Spell a target map as a DDL string."""
    return ", ".join(f"`{name}` {kind}" for name, kind in target.items())
