"""Calendar batches of a historical range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def plan_periods(bounds: DataFrame, unit: str) -> DataFrame:
    """Month or year batches covering the dates ``start_date`` to ``end_date``.

    Months are whole and half-open (``period_end`` is the first of the next month);
    years are clipped to the range (``period_end`` is the last day, inclusive).
    """
    if unit == "month":
        first = F.trunc("start_date", "month").cast("date")
        starts = F.sequence(first, F.col("end_date"), F.expr("INTERVAL 1 MONTH"))
        return bounds.select(F.explode(starts).alias("period_start")).withColumn(
            "period_end", F.add_months("period_start", 1)
        )
    if unit == "year":
        first = F.trunc("start_date", "year").cast("date")
        starts = F.sequence(first, F.col("end_date"), F.expr("INTERVAL 1 YEAR"))
        year_end = F.date_sub(F.add_months("_year", 12), 1)
        return bounds.select("start_date", "end_date", F.explode(starts).alias("_year")).select(
            F.greatest("_year", "start_date").alias("period_start"),
            F.least(year_end, F.col("end_date")).alias("period_end"),
        )
    raise ValueError(f"unknown unit {unit!r}")


def days_between(first: Column, last: Column) -> Column:
    return F.sequence(first, last, F.expr("INTERVAL 1 DAY"))
