"""Aggregates over readings.

``mean`` and ``total`` follow the reading's declared precision. Without
``scale`` they are ordinary floating-point aggregates, whose last bit depends on
the order in which partitions are merged. With ``scale=n`` the reading is a
fixed-point number of ``n`` decimals: the sum runs on whole units in a BIGINT, is
exact, and comes out the same whatever the partitioning or task retries. It is
also the cheaper of the two, as one long per group is merged in place.

A reading that is NaN or infinite fails the job in either form, so does one with more
than ``n`` decimals where a scale is given, and, under ANSI mode, the default, a sum
too big for a BIGINT. Nulls are passed over.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# How far from a whole number of units a scaled reading may be. Doubles that stand for
# up to 11 digits before the point are nearer than that.
FIT = 1e-4


def total(column: str | Column, scale: int | None = None) -> Column:
    """Sum of a reading."""
    value = F.col(column) if isinstance(column, str) else column
    if scale is None:
        return F.sum(checked(value))
    units = F.rint(checked(value, scale) * F.lit(10.0**scale)).cast("bigint")
    return F.sum(units) / F.lit(10.0**scale)


def mean(
    column: str | Column, digits: int | None = None, scale: int | None = None
) -> Column:
    """Mean of a reading, rounded half-up to ``digits``."""
    value = F.col(column) if isinstance(column, str) else column
    if scale is None:
        result = F.avg(checked(value))
    else:
        result = total(value, scale) / F.count(value)
    return result if digits is None else F.round(result, digits)


def precise_sum(*columns: str | Column) -> Column:
    """Row-wise sum of doubles with the rounding errors carried along.

    Each addition's exact error is recovered from the operands and added back at
    the end. For readings of like size (tested: 0 and 1e-6 to 1e6) that is the double
    nearest the true sum, where a plain ``a + b + c`` may be one bit off; among
    numbers more than 2^52 apart, small ones can be lost. Null if any is null; NaN if
    any is NaN or infinities of both signs meet; otherwise an infinity stays, and a
    sum beyond the largest double becomes one. Stays inside generated code.
    """
    values = [F.col(c) if isinstance(c, str) else c for c in columns]
    running, carried = values[0], F.lit(0.0)
    for value in values[1:]:
        added = running + value
        part = added - running
        carried = carried + ((running - (added - part)) + (value - part))
        running = added
    # An infinite reading makes the carried error NaN; the plain sum stands then.
    return F.nanvl(running + carried, running)


def checked(value: Column, scale: int | None = None) -> Column:
    """The reading as a DOUBLE, or an error where it is not finite or does not fit."""
    value = value.cast("double")
    good = F.abs(value) < F.lit(float("inf"))  # nor is NaN, the largest of all
    if scale is not None:
        scaled = value * F.lit(10.0**scale)
        good = good & (F.abs(scaled - F.rint(scaled)) <= FIT)
    text = F.concat(
        F.lit("reading is not finite or does not fit its scale: "), value.cast("string")
    )
    return F.when(value.isNull() | good, value).otherwise(F.raise_error(text).cast("double"))
