"""Scalar trip measures as JVM-side column expressions (no Python in the hot path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def pickup_hour(ts: str | Column) -> Column:
    """Hour of day 0-23 as smallint."""
    return F.hour(_c(ts)).cast("smallint")


def pickup_dow(ts: str | Column) -> Column:
    """Day of week, 1 = Sunday ... 7 = Saturday, as smallint."""
    return F.dayofweek(_c(ts)).cast("smallint")


def key_part(col: str | Column) -> Column:
    """Month / year taken from the partition keys (the file name), not from the timestamp."""
    return _c(col).cast("smallint")


def code_int(col: str | Column) -> Column:
    """Code or count to int; doubles truncate toward zero, values that do not fit become NULL."""
    return _c(col).try_cast("int")


def trip_duration_min(pickup: str | Column, dropoff: str | Column) -> Column:
    """Minutes between whole-second epochs (fractions of a second are dropped first)."""
    return (F.unix_timestamp(_c(dropoff)) - F.unix_timestamp(_c(pickup))) / 60.0


def avg_speed_mph(distance: str | Column, duration_min: str | Column) -> Column:
    """Miles per hour when distance and duration are both positive, else NULL."""
    d, m = _c(distance), _c(duration_min)
    return F.when((d > 0) & (m > 0), d / (m / 60.0)).otherwise(F.lit(None).cast("double"))


def tip_pct(tip: str | Column, fare: str | Column) -> Column:
    """Tip as percent of fare when the fare is positive, else NULL."""
    t, f = _c(tip), _c(fare)
    return F.when(f > 0, (t / f) * 100.0).otherwise(F.lit(None).cast("double"))
