"""Row-to-row functions."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from voltstream.functions.measures import precise_sum
from voltstream.schemas import DEVICE_STATS, ddl

QUARTERS = ("min15", "min30", "min45", "min60")


def device_stats(hourly: DataFrame) -> DataFrame:
    """Charge per hour and mean per quarter hour, as columns. The form to use."""
    summed = hourly.select(
        "device_id", precise_sum(*QUARTERS).alias("total_charge_consumed")
    )
    return summed.withColumn("avg_15", F.col("total_charge_consumed") / 4)


def device_stats_batches(hourly: DataFrame) -> DataFrame:
    """``device_stats`` through Python, one Arrow batch at a time."""

    # Nested functions travel to the executors whole, without this module.
    exact = _exact_sum()

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            device_id, *quarters = (column.to_pylist() for column in batch.columns)
            sums = [None if None in row else exact(row) for row in zip(*quarters)]
            means = [None if s is None else s / 4 for s in sums]
            columns = [device_id, pa.array(sums, pa.float64()), pa.array(means, pa.float64())]
            yield pa.record_batch(columns, ["device_id", "total_charge_consumed", "avg_15"])

    columns = hourly.select(F.col("device_id").cast("string"), *QUARTERS)
    return columns.mapInArrow(stats, ddl(DEVICE_STATS))


def device_stats_row(reading: Row) -> tuple[str, float | None, float | None]:
    """``device_stats`` for one row, for use with ``map_rows``."""
    device_id, *quarters = reading
    if None in quarters:
        return device_id, None, None
    charge = _exact_sum()(quarters)
    return device_id, charge, charge / len(quarters)


def _exact_sum() -> Callable[[Sequence[float]], float]:
    """Exact sum of doubles; what is not finite adds up as by IEEE rules."""

    def exact(values: Sequence[float]) -> float:
        if all(map(math.isfinite, values)):
            try:
                return math.fsum(values)
            except OverflowError:
                pass
        return float(sum(values))

    return exact


def map_rows(
    frame: DataFrame,
    function: Callable[[Row], tuple | None],
    schema: str,
    drop_none: bool = False,
) -> DataFrame:
    """Apply a user's row function to whole rows; ``schema`` names its result.

    The escape hatch for logic that columns cannot express. Rows travel as Arrow
    batches and the function runs once per row, whatever the caller filters on
    later. It may return None for "no row" if ``drop_none`` is set. A result with more
    or fewer fields than the schema fails the job.
    """
    make_row = Row(*frame.columns)
    result = to_arrow_schema(T.StructType.fromDDL(schema))

    def values(column: pa.Array) -> list:
        plain = pa.types.is_integer(column.type) or pa.types.is_floating(column.type)
        if plain and not column.null_count:
            return column.to_numpy().tolist()  # far quicker than value by value
        return column.to_pylist()

    # Nested functions travel to the executors whole, without this module.
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*map(values, batch.columns), strict=True)
            mapped = (function(make_row(*row)) for row in rows)
            kept = [row for row in mapped if not (drop_none and row is None)]
            columns = zip(*kept, strict=True) if kept else ((),) * len(result)
            yield pa.record_batch(
                [pa.array(c, f.type) for c, f in zip(columns, result, strict=True)],
                schema=result,
            )

    return frame.mapInArrow(apply, schema)
