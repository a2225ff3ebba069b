from __future__ import annotations

import random
from datetime import timedelta

import pytest
from conftest import at
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from slotcast.bindings import HOURLY
from slotcast.grid import DAY, HOUR, Grid
from slotcast.operators import features
from slotcast.plans.feature_job import build_features


def by_slot(df, column, key="A"):
    rows = df.filter(F.col("region") == key).orderBy("date_heure").collect()
    return {r.date_heure: r[column] for r in rows}


def gappy(series, days=70, keys=("A", "B"), seed=3, keep=0.8):
    rng = random.Random(seed)
    start = at("2024-01-03T00:00:00")
    return series(
        [
            ((start + timedelta(hours=h)).isoformat(), k, round(rng.uniform(0, 100), 2))
            for k in keys
            for h in range(days * 24)
            if rng.random() < keep
        ]
    )


def test_lag_is_by_time_not_by_row(series, grid):
    df = series([("2024-01-01T00:00:00", "A", 10.0), ("2024-01-03T00:00:00", "A", 30.0)])
    row = features.pit_lag(df, grid).filter("consommation = 30").first()
    assert row.consommation_lag_24h is None
    assert row.consommation_lag_48h == 10.0


def test_rolling_excludes_the_current_slot(series, grid):
    df = series([(f"2024-01-01T00:{15 * i:02d}:00", "A", i + 1.0) for i in range(4)])
    values = by_slot(features.rolling_mean(df, grid), "consommation_rolling_168h")
    assert values[at("2024-01-01T00:00:00")] is None
    assert values[at("2024-01-01T00:45:00")] == 2.0


def test_rolling_window_ends(series, grid):
    df = series(
        [
            ("2023-12-31T23:45:00", "A", 100.0),
            ("2024-01-01T00:00:00", "A", 7.0),
            ("2024-01-08T00:00:00", "A", 1.0),
        ]
    )
    values = by_slot(features.rolling_mean(df, grid), "consommation_rolling_168h")
    assert values[at("2024-01-08T00:00:00")] == 7.0


def test_null_values_are_skipped(series, grid):
    df = series(
        [
            ("2024-01-01T00:00:00", "A", None),
            ("2024-01-01T00:15:00", "A", 4.0),
            ("2024-01-01T00:30:00", "A", 8.0),
        ]
    )
    values = by_slot(features.rolling_mean(df, grid), "consommation_rolling_168h")
    assert values[at("2024-01-01T00:15:00")] is None
    assert values[at("2024-01-01T00:30:00")] == 4.0


def test_blocks_equal_one_window_over_the_whole_series(series):
    """Growing frames in blocks against a sliding frame over each whole series."""
    df = gappy(series)
    whole = Window.partitionBy("region").orderBy(F.unix_seconds("date_heure"))
    sliding = df.select(
        "date_heure",
        "region",
        F.avg("consommation").over(whole.rangeBetween(-168 * HOUR, -HOUR)).alias("r"),
        *[
            F.max("consommation").over(whole.rangeBetween(-h * HOUR, -h * HOUR)).alias(f"l{h}")
            for h in features.LAGS
        ],
    ).persist()
    for block_days in (7, 28):
        for grid in (HOURLY, Grid(step=HOUR)):
            ours = features.history_features(df, grid, block_days=block_days)
            both = ours.join(sliding, ["date_heure", "region"])
            assert ours.count() == both.count() == df.count()
            same_lags = " AND ".join(f"consommation_lag_{h}h <=> l{h}" for h in features.LAGS)
            same_mean = (
                "(r IS NULL AND consommation_rolling_168h IS NULL)"
                " OR abs(r - consommation_rolling_168h) < 1e-9"
            )
            wrong = both.filter(f"NOT coalesce({same_lags} AND ({same_mean}), false)")
            assert wrong.count() == 0


def test_block_shorter_than_the_look_back_is_refused(series, grid):
    with pytest.raises(ValueError):
        features.history_features(series([]), grid, block_days=6)


def test_window_lag_equals_join_lag(series):
    df = gappy(series, days=20).select("date_heure", "region", "consommation")
    a, b = features.pit_lag(df, HOURLY), features.pit_lag_join(df, HOURLY)
    assert a.exceptAll(b.select(*a.columns)).count() == 0
    assert a.count() == b.count()


def test_frame_sizes_are_bounded_by_the_grid(series):
    """However long the series, a window group holds block + reach slots at most."""
    df = gappy(series, days=200, keys=("A",), keep=1.0)
    blocks = features.history_blocks(df, "date_heure", 168 * HOUR, 28 * DAY)
    largest = blocks.groupBy("region", "_block").count().agg(F.max("count")).first()[0]
    assert largest <= (28 + 7) * 24
    assert blocks.count() <= df.count() * 1.3


def test_hourly_join_truncates_and_keeps_unmatched(series, spark, grid):
    df = series([("2024-01-01T00:45:00", "A", 1.0), ("2024-01-01T01:00:00", "A", 2.0)])
    weather = spark.createDataFrame(
        [(at("2024-01-01T00:10:00"), "A", 4.0, 1.0, None), (at("2024-01-01T00:50:00"), "A", 6.0, 3.0, None)],
        "date_heure timestamp, region string, temperature_celsius double, wind_speed_kmh double,"
        " solar_radiation_wm2 double",
    )
    out = features.join_hourly(df, features.hourly_mean(weather, grid), grid)
    values = by_slot(out, "temperature_celsius")
    assert values == {at("2024-01-01T00:45:00"): 5.0, at("2024-01-01T01:00:00"): None}


WEATHER = (
    "date_heure timestamp, region string, temperature_celsius double, wind_speed_kmh double,"
    " solar_radiation_wm2 double"
)


def test_since_emits_only_later_rows_with_full_history(series, spark):
    df = gappy(series, days=20)
    weather = spark.createDataFrame([], WEATHER)
    full = build_features(df, weather, HOURLY)
    part = build_features(df, weather, HOURLY, since="2024-01-15T06:00:00")
    expected = full.filter(F.col("date_heure") > F.lit("2024-01-15T06:00:00").cast("timestamp"))
    assert part.count() == expected.count() > 0
    assert part.exceptAll(expected.select(*part.columns)).count() == 0


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cut=st.integers(24, 400), change=st.floats(1, 1e4))
def test_no_leak(series, spark, cut, change):
    """A value at or after T never reaches a feature at T."""
    df = gappy(series, days=20, keys=("A",)).persist()
    weather = spark.createDataFrame([], WEATHER)
    moment = F.lit((at("2024-01-03T00:00:00") + timedelta(hours=cut)).isoformat()).cast("timestamp")
    later = F.when(F.col("date_heure") >= moment, F.col("consommation") + change)
    changed = df.withColumn("consommation", later.otherwise(F.col("consommation")))
    a = build_features(df, weather, HOURLY).filter(F.col("date_heure") <= moment)
    b = build_features(changed, weather, HOURLY).filter(F.col("date_heure") <= moment)
    assert a.exceptAll(b).count() == 0


def test_empty_input_keeps_the_schema(series, spark, grid):
    out = build_features(series([]), spark.createDataFrame([], WEATHER), grid)
    assert out.count() == 0
    assert "consommation_rolling_168h" in out.columns
    assert "is_public_holiday_fr" in out.columns


def test_no_python_and_no_cross_join_in_the_plan(series, spark):
    plan = build_features(gappy(series, days=2), spark.createDataFrame([], WEATHER), HOURLY)
    text = plan._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text
