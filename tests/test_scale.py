"""Shapes that must hold when the data grows: hot cells, hot series, shuffles per plan."""

from __future__ import annotations

import re

import pytest
from conftest import at
from pyspark.sql import functions as F

from slotcast.grid import DAY, HOUR, Grid
from slotcast.operators import clean, features
from slotcast.plans.feature_job import build_features
from slotcast.plans.forecast_job import forecast_frame
from slotcast.queries import QUERIES

HOURLY = Grid(step=HOUR, scale=2)
WEATHER = (
    "date_heure timestamp, region string, temperature_celsius double, wind_speed_kmh double,"
    " solar_radiation_wm2 double"
)


@pytest.fixture
def no_broadcast(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot_rows(spark):
    """A third of 60,000 records fall on one cell, the rest on 4,000 cells."""
    return spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-05T00:00:00").cast("timestamp"))
        .otherwise(F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod(F.hash("id"), F.lit(400)) * 3600))
        .alias("date_heure"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 10).cast("string")))
        .alias("region"),
        (F.col("id") % 997).cast("double").alias("consommation"),
        F.timestamp_seconds(F.lit(1_710_000_000) + F.pmod(F.hash("id", F.lit(1)), F.lit(50_000))).alias(
            "_ingested_at"
        ),
    )


def test_hot_cell_gives_the_exact_latest_row(spark):
    rows = hot_rows(spark).persist()
    ours = clean.dedupe_latest(rows, HOURLY)
    brute = rows.groupBy("date_heure", "region").agg(
        F.max(F.struct("_ingested_at", "consommation")).alias("m")
    ).select("date_heure", "region", "m.consommation", "m._ingested_at")
    assert ours.count() == brute.count() > 3000
    assert ours.exceptAll(brute).count() == 0


def test_hot_series_is_spread_over_all_tasks(spark):
    """One series of 20 years falls into many groups of bounded size."""
    series = spark.range(20 * 365 * 24).select(
        F.timestamp_seconds(F.lit(1_000_000_000 // HOUR * HOUR) + F.col("id") * HOUR).alias("date_heure"),
        F.lit("hot").alias("region"),
        F.lit(1.0).alias("consommation"),
    )
    blocks = features.history_blocks(series, "date_heure", 168 * HOUR, 28 * DAY)
    per_task = (
        blocks.repartition(8, "region", "_block").groupBy(F.spark_partition_id()).count().collect()
    )
    share = max(r["count"] for r in per_task) / sum(r["count"] for r in per_task)
    assert len(per_task) == 8
    assert share < 0.25


def test_features_shuffle_the_slots_twice(spark, no_broadcast):
    """Deduplication and history; the join finds the slots in place."""
    raw, weather = hot_rows(spark), spark.createDataFrame([], WEATHER)
    plan = plan_of(build_features(raw, weather, HOURLY))
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    names = [[k.split("#")[0].strip() for k in key.split(",")[:-1]] for key in keys]
    assert names.count(["date_heure", "region"]) == 1
    assert names.count(["region", "_block"]) == 2  # the slots once, the hourly means once
    assert not any(key == ["region"] for key in names)
    unique = plan_of(build_features(raw, weather, HOURLY, deduplicate=False))
    assert len(re.findall("Exchange hashpartitioning", unique)) == len(keys) - 1


def test_skipping_deduplication_changes_nothing_on_unique_rows(spark):
    raw, weather = clean.dedupe_latest(hot_rows(spark), HOURLY), spark.createDataFrame([], WEATHER)
    a, b = build_features(raw, weather, HOURLY), build_features(raw, weather, HOURLY, deduplicate=False)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0


def test_quarter_hour_forecast_frame_equals_brute_force(spark):
    """96 slots, 15-minute gap, weather of the containing hour."""
    grid = Grid(scale=2)
    history = spark.sql(
        "SELECT timestamp'2024-05-01' + make_dt_interval(0, 0, 15 * i) AS date_heure, region,"
        " round(abs(hash(i, region)) % 10000 / 100D, 2) AS consommation"
        " FROM (SELECT explode(sequence(0, 96 * 16)) AS i),"
        " (SELECT explode(array('A', 'B')) AS region) WHERE hash(region, i) % 4 != 0"
    ).persist()
    hourly = spark.sql(
        "SELECT timestamp'2024-05-01' + make_dt_interval(0, h) AS hour_dt, region,"
        " CAST(h AS DOUBLE) AS temperature_celsius, 1D AS wind_speed_kmh, 2D AS solar_radiation_wm2"
        " FROM (SELECT explode(sequence(0, 24 * 18)) AS h), (SELECT explode(array('A', 'B')) AS region)"
    )
    keys = spark.createDataFrame([("A",), ("B",)], "region string")
    rows = forecast_frame(history, hourly, keys, "2024-05-15", "2024-05-15", grid).collect()
    assert len(rows) == 2 * 96
    values = {(r.date_heure, r.region): r.consommation for r in history.collect()}
    from datetime import timedelta

    for r in rows:
        moment = r.forecast_horizon_dt - timedelta(hours=24)
        lag = {h: values.get((moment - timedelta(hours=h), r.region)) for h in (24, 48, 168)}
        window = [
            v
            for (t, k), v in values.items()
            if k == r.region
            and moment - timedelta(hours=168) <= t <= moment - timedelta(minutes=15)
        ]
        assert r.consommation_lag_48h == lag[48] and r.consommation_lag_168h == lag[168]
        assert r.consommation_lag_24h == (lag[24] if lag[24] is not None else lag[48])
        assert r.used_fallback == (lag[24] is None and lag[48] is not None)
        assert r.consommation_rolling_168h == pytest.approx(sum(window) / len(window), abs=1e-9)
        hours = (r.forecast_horizon_dt - at("2024-05-01T00:00:00")).total_seconds() // 3600
        assert r.temperature_celsius == hours


@pytest.mark.parametrize("name", ["time_range", "refresh_window", "read_backfill", "build_features_since"])
def test_time_bounds_reach_the_scan(spark, name):
    plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    assert any("GreaterThanOrEqual(ts" in filters for filters in pushed), pushed
