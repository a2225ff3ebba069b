"""Arithmetic on slot times.  Everything steps in absolute seconds (UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds(time: Column | str) -> Column:
    """Epoch seconds of a timestamp, with or without zone (session zone is UTC)."""
    column = F.col(time) if isinstance(time, str) else time
    return F.unix_seconds(column.cast("timestamp"))


def from_seconds(value: Column) -> Column:
    return F.timestamp_seconds(value)


def shift(time: Column | str, seconds_: int) -> Column:
    """``time`` moved by an elapsed number of seconds; negative moves back."""
    column = F.col(time) if isinstance(time, str) else time
    return column + F.expr(f"INTERVAL '{int(seconds_)}' SECOND")


def hour_of(time: Column | str) -> Column:
    """Start of the containing hour, as an instant."""
    column = F.col(time) if isinstance(time, str) else time
    return F.date_trunc("hour", column.cast("timestamp")).cast("timestamp")


def instant(text: str) -> Column:
    """Literal UTC instant from ISO text, so that it folds and reaches the scan."""
    return F.to_timestamp(F.lit(text))
