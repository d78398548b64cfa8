"""Time functions that give the same results in every session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(name: str) -> Column:
    """Microseconds of a timestamp column, with or without zone, since 1970 on its own clock."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast(`{name}` as timestamp_ntz))")


def day_of_millis(name: str) -> Column:
    """UTC date of epoch milliseconds."""
    return F.expr(f"date_add(DATE'1970-01-01', cast(floor(`{name}` / 86400000) as int))")


def truncated(unit: str, name: str) -> Column:
    """Start of the unit on the timestamp's own clock, without zone."""
    return F.date_trunc(unit, F.col(name)).cast("timestamp_ntz")
