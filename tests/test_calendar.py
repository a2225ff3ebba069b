from __future__ import annotations

import pytest
from conftest import at
from pyspark.sql import functions as F

from slotcast.functions.calendar import calendar, easter_sunday

# Western Easter Sundays as published.
EASTERS = {
    1995: (4, 16), 2000: (4, 23), 2008: (3, 23), 2011: (4, 24), 2019: (4, 21), 2020: (4, 12),
    2021: (4, 4), 2022: (4, 17), 2023: (4, 9), 2024: (3, 31), 2025: (4, 20), 2038: (4, 25),
    1954: (4, 18), 1981: (4, 19), 2049: (4, 18), 2076: (4, 19), 1818: (3, 22),
}


def parts(spark, *times):
    df = spark.createDataFrame([(at(t),) for t in times], "date_heure timestamp")
    return calendar(df, "date_heure", "Europe/Paris").orderBy("date_heure").collect()


def test_easter(spark):
    years = spark.createDataFrame([(y,) for y in EASTERS], "y int")
    rows = years.select("y", F.expr(easter_sunday("y")).alias("e")).collect()
    assert {r.y: (r.e.month, r.e.day) for r in rows} == EASTERS


@pytest.mark.parametrize(
    "time, expected",
    [
        ("2024-11-01T12:00:00", True),
        ("2024-07-14T12:00:00", True),
        ("2024-01-01T12:00:00", True),
        ("2024-11-04T12:00:00", False),
        ("2024-07-15T12:00:00", False),
        ("2024-03-31T12:00:00", False),
        ("2024-04-01T12:00:00", True),
        ("2024-05-09T12:00:00", True),
        ("2024-05-20T12:00:00", True),
        ("2024-05-08T12:00:00", True),
        ("2024-08-15T12:00:00", True),
        ("2024-12-25T12:00:00", True),
        ("2024-12-26T12:00:00", False),
    ],
)
def test_holidays(spark, time, expected):
    assert parts(spark, time)[0].is_public_holiday_fr is expected


def test_eleven_holidays_a_year(spark):
    days = spark.sql(
        "SELECT explode(sequence(timestamp'1995-01-01 12:00:00', timestamp'2030-12-31 12:00:00',"
        " interval 1 day)) AS date_heure"
    )
    per_year = (
        calendar(days, "date_heure", "Europe/Paris")
        .filter("is_public_holiday_fr")
        .groupBy(F.year("date_heure").alias("y"))
        .count()
        .collect()
    )
    # Ascension meets 8 May in 1997 and 1 May in 2008; otherwise the eleven are distinct.
    assert {r.y for r in per_year if r["count"] != 11} == {1997, 2008}


def test_clock_change_and_year_end(spark):
    new_year, easter = parts(spark, "2023-12-31T23:30:00", "2024-03-31T01:30:00")
    assert (new_year.hour_of_day, new_year.month, new_year.is_public_holiday_fr) == (0, 1, True)
    assert (easter.hour_of_day, easter.day_of_week, easter.is_weekend) == (3, 6, True)
    assert easter.is_public_holiday_fr is False
