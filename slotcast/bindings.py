"""The test tables seen as contract tables: series, readings, keys.

``events`` becomes an hourly series keyed by event type (several records per slot, so
deduplication is real); ``orders`` becomes a daily series of several years keyed by
priority.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import numeric
from .grid import DAY, HOUR, Grid

HOURLY = Grid(step=HOUR, scale=2)
DAILY = Grid(step=DAY, scale=2)
USERS = Grid(step=HOUR, key="user_id", scale=2)

AS_OF = "2024-01-31T00:00:00"
DAILY_AS_OF = "2001-08-02T00:00:00"
N_KEYS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(
    spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    """Events whose hour can lie in ``[since, until]``.

    A slot is the hour of ``ts``, which no bound on slots passes on its way to the files;
    these bounds, widened to whole hours, are on ``ts`` itself and reach the scan.
    """
    rows = table(spark, sf_dir, "events")
    kind = rows.schema["ts"].dataType
    if since is not None:
        rows = rows.filter(F.col("ts") >= F.lit(hour_text(since)).cast(kind))
    if until is not None:
        rows = rows.filter(F.col("ts") < F.lit(hour_text(until, 1)).cast(kind))
    return rows


def hour_text(text: str, hours: int = 0) -> str:
    """The containing hour of an ISO time, moved by whole hours."""
    whole = datetime.fromisoformat(text).replace(minute=0, second=0, microsecond=0)
    return (whole + timedelta(hours=hours)).isoformat()


def consumption(
    spark: SparkSession,
    sf_dir: str,
    key: str = "event_type",
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """Raw hourly records: slot, key, value, ingestion time, record id."""
    ts = F.col("ts").cast("timestamp")
    return events(spark, sf_dir, since, until).select(
        F.date_trunc("hour", ts).alias("date_heure"),
        F.col(key).alias("region" if key == "event_type" else key),
        F.col("value").alias("consommation"),
        ts.alias("_ingested_at"),
        "event_id",
    )


def weather(spark: SparkSession, sf_dir: str, since: str | None = None) -> DataFrame:
    """Several readings of three measures per hour and key."""
    ts = F.col("ts").cast("timestamp")
    return events(spark, sf_dir, since).select(
        F.date_trunc("hour", ts).alias("date_heure"),
        F.col("event_type").alias("region"),
        F.get_json_object("props", "$.k").cast("double").alias("temperature_celsius"),
        (F.col("user_id") % 37).cast("double").alias("wind_speed_kmh"),
        (F.col("event_id") % 997).cast("double").alias("solar_radiation_wm2"),
        ts.alias("_ingested_at"),
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sums per order priority over several years, with gaps."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.col("o_orderdate").cast("timestamp").alias("date_heure"),
            F.col("o_orderpriority").alias("region"),
        )
        .agg(numeric.total("o_totalprice", 2).alias("consommation"))
        .withColumn("_ingested_at", F.col("date_heure"))
    )


def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("region")).distinct()


def daily_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("region")).distinct()
    )
