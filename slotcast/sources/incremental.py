"""Where an incremental read starts, and which feed of a series wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timegrid import instant, shift
from ..grid import DAY, HOUR, Grid
from ..operators.clean import latest_per, time_range

# Re-read overlap, first-run look-back, correction window.
OVERLAP_HOURS = 6
DEFAULT_LOOKBACK_DAYS = 7
REFRESH_HOURS = 168


def high_water_mark(df: DataFrame, time: str) -> DataFrame:
    """One row: the latest ``time``, NULL if the table is empty."""
    return df.agg(F.max(time).alias("hwm"))


def since_with_overlap(
    hwm: DataFrame,
    as_of: str,
    overlap_hours: int = OVERLAP_HOURS,
    default_days: int = DEFAULT_LOOKBACK_DAYS,
) -> DataFrame:
    """Incremental start: mark minus the overlap, or a default look-back on an empty table.

    The overlap reads late publishers again; the upsert absorbs the repeats.
    """
    fallback = shift(instant(as_of), -default_days * DAY)
    return hwm.select(
        F.coalesce(shift("hwm", -overlap_hours * HOUR), fallback).alias("since")
    )


def refresh_window(
    df: DataFrame, grid: Grid, as_of: str, hours: int = REFRESH_HOURS
) -> DataFrame:
    """Rows of the last ``hours``, to be re-read and upserted for late corrections."""
    start = shift(instant(as_of), -hours * HOUR)
    return time_range(df, grid.time, end=as_of).filter(F.col(grid.time) > start)


def prefer_source(
    feeds: Sequence[DataFrame], grid: Grid, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """One row per (slot, key) from the first feed that has it, latest ingestion first.

    ``feeds`` are in order of preference: consolidated before real-time, observed
    before forecast.
    """
    ranked = [f.withColumn("_feed", F.lit(-i)) for i, f in enumerate(feeds)]
    union = ranked[0]
    for feed in ranked[1:]:
        union = union.unionByName(feed)
    order = ["_feed", grid.ingested, *(tiebreak or [grid.value])]
    return latest_per(union, grid.keys, order).drop("_feed")


def exogenous_source(day: Column, as_of_day: Column, archive_after_days: int = 5) -> Column:
    """Which weather feed serves a day: the archive once it is old enough."""
    old = F.date_diff(as_of_day, day) >= archive_after_days
    return F.when(old, F.lit("archive")).otherwise(F.lit("forecast"))
