"""Local calendar parts and French public holidays, as plain column expressions.

No join and no Python: the holiday test is arithmetic on the local date, valid for
every Gregorian year, and stays inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Public holidays with a fixed date, as (month, day).
FIXED_HOLIDAYS = [
    (1, 1),
    (5, 1),
    (5, 8),
    (7, 14),
    (8, 15),
    (11, 1),
    (11, 11),
    (12, 25),
]

# Days after Easter Sunday (Easter Monday, Ascension, Whit Monday).
EASTER_HOLIDAYS = [1, 39, 50]


def local_time(time: Column | str, tz: str) -> Column:
    """Wall-clock time in ``tz`` of a UTC instant."""
    column = F.col(time) if isinstance(time, str) else time
    return F.from_utc_timestamp(column.cast("timestamp"), tz)


def utc_of_local(wall: Column, tz: str) -> Column:
    """UTC instant of a wall-clock time in ``tz``."""
    return F.to_utc_timestamp(wall, tz)


def easter_sunday(year: str) -> str:
    """SQL of Gregorian Easter for an integer SQL expression (Meeus/Jones/Butcher).

    Counted in days after 22 March.
    """
    century = f"({year} div 100)"
    golden = f"({year} % 19)"
    moon_shift = f"(({century} - ({century} + 8) div 25 + 1) div 3)"
    moon = f"((19 * {golden} + {century} - {century} div 4 - {moon_shift} + 15) % 30)"
    rest = f"({year} % 100)"
    weekday = f"((32 + 2 * ({century} % 4) + 2 * ({rest} div 4) - {moon} - {rest} % 4) % 7)"
    late = f"(({golden} + 11 * {moon} + 22 * {weekday}) div 451)"
    return (
        f"date_add(make_date({year}, 3, 22), CAST({moon} + {weekday} - 7 * {late} AS INT))"
    )


def is_holiday(local_date: str) -> Column:
    """Is the local date in this column a French public holiday?"""
    fixed = ", ".join(str(month * 100 + day) for month, day in FIXED_HOLIDAYS)
    movable = ", ".join(str(days) for days in EASTER_HOLIDAYS)
    easter = easter_sunday(f"year({local_date})")
    # Easter holidays fall in March to June only; the guard skips the arithmetic.
    return F.expr(
        f"month({local_date}) * 100 + day({local_date}) IN ({fixed}) OR"
        f" (month({local_date}) BETWEEN 3 AND 6"
        f"  AND date_diff({local_date}, {easter}) IN ({movable}))"
    )


def calendar(df: DataFrame, time: str, tz: str) -> DataFrame:
    """Add hour_of_day, day_of_week (0 = Monday), month, weekend and holiday flags."""
    return (
        df.withColumn("_wall", local_time(time, tz))
        .withColumn("_date", F.to_date("_wall"))
        .withColumns(
            {
                "hour_of_day": F.expr("hour(_wall)"),
                "day_of_week": F.expr("weekday(_date)"),
                "month": F.expr("month(_date)"),
                "is_weekend": F.expr("weekday(_date) >= 5"),
                "is_public_holiday_fr": is_holiday("_date"),
            }
        )
        .drop("_wall", "_date")
    )
