"""Queries follow the range of the bound table."""

from __future__ import annotations

from functools import partial

import pytest
from pyspark.sql import functions as F

from slotcast.plans import walk_forward
from slotcast.queries import QUERIES, event_days


@pytest.fixture(scope="module")
def moved(spark, tmp_path_factory):
    """Two keys with one record an hour from 2024-01-25 to 2024-02-06, daily sums to 2001-08-05."""
    root = str(tmp_path_factory.mktemp("ranges"))
    hours = F.explode(F.sequence(*[F.lit(t).cast("timestamp") for t in ("2024-01-25 00:10:00", "2024-02-06 23:10:00")], F.expr("interval 1 hour")))
    rows = spark.range(2).select(F.col("id").alias("key"), hours.alias("ts"))
    rows.select(
        F.xxhash64("key", "ts").alias("event_id"), "ts", F.col("key").alias("user_id"),
        F.element_at(F.array(F.lit("click"), F.lit("view")), (F.col("key") + 1).cast("int")).alias("event_type"),
        (F.hour("ts") + F.col("key")).cast("double").alias("value"), F.lit('{"k": 1}').alias("props"),
    ).write.parquet(f"{root}/events.parquet")
    days = F.explode(F.sequence(F.lit("2001-07-20").cast("timestamp"), F.lit("2001-08-05").cast("timestamp"), F.expr("interval 1 day")))
    spark.range(1).select(
        days.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"), F.lit(10.0).alias("o_totalprice")
    ).write.parquet(f"{root}/orders.parquet")
    return root


def test_days_of_the_table(spark, moved):
    assert event_days(spark, moved) == ("2024-01-25", "2024-02-06")
    assert event_days(spark, moved, later=1) == ("2024-01-26", "2024-02-07")


@pytest.mark.parametrize("name", ["scaffold", "aligned_lags", "aligned_rolling", "forecast_frame", "forecast_frame_as_known"])
def test_every_day_has_slots(spark, moved, name):
    days = QUERIES[name](spark, moved).groupBy("forecast_date").count().collect()
    assert sorted(str(r["forecast_date"]) for r in days) == [
        *(f"2024-01-{d}" for d in range(25, 32)), *(f"2024-02-0{d}" for d in range(1, 7))
    ]
    assert {r["count"] for r in days} == {48}


def test_predictions_and_metrics_reach_the_last_day(spark, moved):
    last = QUERIES["naive_forecast"](spark, moved).agg(F.max("forecast_date")).first()[0]
    assert str(last) == "2024-02-06"
    days = QUERIES["metrics_backfill"](spark, moved).agg(F.max("computed_date")).first()[0]
    assert str(days) == "2024-02-07"


def test_daily_series_to_its_own_end(spark, moved):
    first, last = QUERIES["lag_fallback"](spark, moved).agg(F.min("forecast_date"), F.max("forecast_date")).first()
    assert (str(first), str(last)) == ("2001-07-20", "2001-08-05")


def test_learned_walk_forward_predicts_every_day_past_the_gate(spark, moved, monkeypatch):
    monkeypatch.setattr(walk_forward, "Folds", partial(walk_forward.Folds, min_rows=144))
    days = QUERIES["walk_forward_gbt"](spark, moved).select("forecast_date").distinct().collect()
    assert sorted(str(r[0]) for r in days) == [
        "2024-01-30", "2024-01-31", *(f"2024-02-0{d}" for d in range(1, 7))
    ]
