"""Windowed jobs: plant means, device charge, and the join of two feeds.

Every function is a transform of frames that already have a time attribute (see
``voltstream.streaming.attributes``), so it serves tables and streams alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltstream.functions.measures import checked, mean, total
from voltstream.functions.records import conform
from voltstream.operators.windows import HEARTBEAT, bounds, join_windows, tumble
from voltstream.schemas import JOINED_WINDOW


def plant_means(
    readings: DataFrame,
    time: str = "proctime",
    size: str = "60 seconds",
    scale: int | None = None,
) -> DataFrame:
    """Mean output and irradiance per plant and window, to two digits."""
    measures = {
        "Potencia": mean("potencia", 2, scale),
        "Radiacion": mean("radiacion", 2, scale),
    }
    return bounds(tumble(readings, time, size, measures, keys=("planta_id",)))


def device_charge(
    readings: DataFrame,
    time: str = "proctime",
    size: str = "30 seconds",
    scale: int | None = None,
) -> DataFrame:
    """Charge consumed per device and window."""
    measures = {"charge_consumed": total("ampere_hour", scale)}
    return bounds(tumble(readings, time, size, measures, keys=("device_id",)))


def device_charge_sql(readings: DataFrame, scale: int | None = None) -> DataFrame:
    """``device_charge`` on ``proctime``, in SQL. Heartbeats, if any, are left out.

    With ``scale`` the readings are summed as decimals of so many places, exactly.
    """
    if scale is not None:
        readings = _exact(readings, "ampere_hour", scale)
    if HEARTBEAT not in readings.columns:
        readings = readings.withColumn(HEARTBEAT, F.lit(False))
    return readings.sparkSession.sql(
        """
        SELECT device_id, window.start AS window_start, window.end AS window_end,
               CAST(charge_consumed AS DOUBLE) AS charge_consumed
        FROM (
            SELECT device_id, window, sum(ampere_hour) AS charge_consumed,
                   count_if(NOT _heartbeat) AS n
            FROM {readings}
            GROUP BY device_id, window(proctime, '30 seconds'))
        WHERE n > 0
        """,
        readings=readings,
    )


def joined_means(
    irradiance: DataFrame,
    inverter: DataFrame,
    size: str = "10 minutes",
    scale: int | None = None,
) -> DataFrame:
    """Mean irradiance and inverter power of every window that has both."""
    sun = {"Radiacion": mean("Radiacion", 1, scale)}
    power = {"PA": mean("PA_Inv", 1, scale)}
    left = tumble(irradiance, "ts_ltz", size, sun)
    right = tumble(inverter, "ts_ltz", size, power)
    return conform(bounds(join_windows(left, right)), JOINED_WINDOW)


def paired_means(
    readings: DataFrame,
    irradiance: Column,
    power: Column,
    size: str = "10 minutes",
    scale: int | None = None,
) -> DataFrame:
    """``joined_means`` for two feeds that lie in one table or topic.

    ``irradiance`` and ``power`` give a row's value, or null where the row belongs to
    the other feed. One scan and one shuffle do for both, and a stream keeps no join
    state; a window comes out if it has values of both.
    """
    sides = {"Radiacion": irradiance, "PA": power}
    measures = {name: mean(value, 1, scale) for name, value in sides.items()}
    windowed = tumble(readings, "ts_ltz", size, measures)
    return conform(bounds(windowed.dropna(subset=list(sides))), JOINED_WINDOW)


def joined_means_sql(
    irradiance: DataFrame,
    inverter: DataFrame,
    views: tuple[str, str] | None = None,
    scale: int | None = None,
) -> DataFrame:
    """``joined_means`` in SQL, as two named sub-queries and a join that rounds again.

    ``views`` publishes the sub-queries under those names for other queries. With
    ``scale`` the readings are averaged as decimals of so many places, exactly.
    """
    spark = irradiance.sparkSession
    if scale is not None:
        irradiance = _exact(irradiance, "Radiacion", scale)
        inverter = _exact(inverter, "PA_Inv", scale)
    left = spark.sql(
        """
        SELECT window AS w, round(avg(Radiacion), 1) AS Radiacion
        FROM {irradiance} GROUP BY window(ts_ltz, '10 minutes')
        """,
        irradiance=irradiance,
    )
    right = spark.sql(
        """
        SELECT window AS w, round(avg(PA_Inv), 1) AS PA
        FROM {inverter} GROUP BY window(ts_ltz, '10 minutes')
        """,
        inverter=inverter,
    )
    for view, frame in zip(views or (), (left, right)):
        frame.createOrReplaceTempView(view)
    return spark.sql(
        """
        SELECT e.w.start AS window_start, e.w.end AS window_end,
               CAST(round(e.Radiacion, 1) AS FLOAT) AS Radiacion,
               CAST(round(i.PA, 1) AS FLOAT) AS PA
        FROM {left} e INNER JOIN {right} i ON e.w = i.w
        """,
        left=left,
        right=right,
    )


def _exact(frame: DataFrame, measure: str, scale: int) -> DataFrame:
    """A measure as a decimal; a reading that has more places fails the job."""
    exact = checked(F.col(measure), scale).cast(f"decimal(18, {scale})")
    return frame.withColumn(measure, exact)
