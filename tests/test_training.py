from __future__ import annotations

from datetime import timedelta

import pytest
from conftest import at
from pyspark.sql import functions as F

from slotcast.bindings import DAILY, HOURLY
from slotcast.functions import numeric
from slotcast.grid import DAY, HOUR, Grid
from slotcast.operators import evaluation, training
from slotcast.plans import backtest


def test_split_is_by_time_range(spark):
    df = spark.sql(
        "SELECT timestamp'2024-01-01 00:00:00' + make_dt_interval(0, h) AS date_heure"
        " FROM (SELECT explode(sequence(0, 100)) AS h)"
    )
    split = training.time_split(df, "date_heure")
    last_train = split.filter("split = 'train'").agg(F.max("date_heure")).first()[0]
    assert last_train == at("2024-01-01T00:00:00") + timedelta(hours=80)
    assert split.filter("split = 'val'").count() == 20


def test_gate(spark):
    assert not training.enough_rows(spark.range(199))
    assert training.enough_rows(spark.range(200))


def test_encode_unknown_is_missing(spark):
    df = spark.createDataFrame([("b", True), ("a", False), ("z", None)], "region string, w boolean")
    rows = {r.region: (r.region_idx, r.w) for r in training.encode(df, ["a", "b"], "region").collect()}
    assert rows == {"a": (0, 0), "b": (1, 1), "z": (None, None)}


def features_frame(spark, times):
    return spark.createDataFrame(
        [(at(t), "A", lag, 0.0) for t, lag in times],
        "date_heure timestamp, region string, consommation_lag_24h double, consommation_lag_168h double",
    )


def test_target_is_the_latest_value_a_day_later(spark, series, grid):
    features = features_frame(spark, [("2024-01-02T00:00:00", 1.0), ("2024-01-03T00:00:00", None)])
    raw = series(
        [
            ("2024-01-03T00:00:00", "A", 5.0, "2024-01-04T00:00:00"),
            ("2024-01-03T00:00:00", "A", 6.0, "2024-01-05T00:00:00"),
            ("2024-01-04T00:00:00", "A", 7.0),
        ]
    )
    rows = training.training_frame(
        features, raw, grid, as_of="2024-02-01T00:00:00", exog_at="reference"
    ).collect()
    assert [(r.date_heure, r.consommation) for r in rows] == [(at("2024-01-02T00:00:00"), 6.0)]


def test_cutoff_hides_later_targets(spark, series, grid):
    features = features_frame(spark, [("2024-01-01T00:00:00", 1.0), ("2024-01-02T00:00:00", 1.0)])
    raw = series([("2024-01-02T00:00:00", "A", 1.0), ("2024-01-03T00:00:00", "A", 2.0)])
    known = training.training_frame(
        features, raw, grid, cutoff="2024-01-03T00:00:00", exog_at="reference"
    )
    assert [r.consommation for r in known.collect()] == [1.0]


def test_target_time_needs_readings(spark, series, grid):
    with pytest.raises(ValueError):
        training.training_frame(features_frame(spark, []), series([]), grid, as_of="2024-01-01")


def test_stale_versions_keep_the_newest(spark):
    rows = [(f"r{i}", at(f"2024-01-{i + 1:02d}T00:00:00")) for i in range(10)]
    rows.append(("r0", at("2024-03-01T00:00:00")))  # a late file does not make a run younger
    df = spark.createDataFrame(rows, "run string, created timestamp")
    stale = training.stale_versions(df, "run", "created", keep=7)
    assert sorted(r.run for r in stale.collect()) == ["r0", "r1", "r2"]
    assert training.stale_versions(df, "run", "created", keep=20).count() == 0
    newest = training.latest_run(df.filter("run != 'r0'"), "run", "created").first()
    assert newest.run == "r9"


def test_metrics_of_known_errors(spark):
    df = spark.createDataFrame([(0.0, float(e)) for e in (1, -1, 2, -2)], "y double, p double")
    row = evaluation.eval_metrics(df, "y", "p").first()
    assert (row.mae, row.rmse, row.r2, row.n) == (1.5, 1.58, None, 4)


def test_sample_is_seeded_and_whole_when_small(spark):
    df = spark.range(100).select("id", F.lit(1.0).alias("y"), F.lit(2.0).alias("p"))
    draw = lambda d, n, s=42: {
        r.id for r in evaluation.prediction_error_sample(d, "y", "p", ["id"], n, s).collect()
    }
    assert draw(df, 10) == draw(df.repartition(7), 10)
    assert draw(df, 10) != draw(df, 10, 1)
    assert len(draw(df, 1000)) == 100


def test_folds_equal_brute_force(spark):
    """Running totals against the spelled-out join of days and rows."""
    frame = spark.sql(
        "SELECT timestamp'2023-06-01' + make_dt_interval(0, h) AS date_heure, region,"
        " round(abs(hash(h, region) % 9973) / 100D, 2) AS consommation,"
        " round(abs(hash(region, h) % 9967) / 100D, 2) AS consommation_lag_24h"
        " FROM (SELECT explode(sequence(0, 24 * 150)) AS h),"
        " (SELECT explode(array('A', 'B')) AS region) WHERE hash(h) % 3 != 0"
    ).persist()
    ours = backtest.fold_summary(
        frame, HOURLY, "2023-05-25", "2023-12-01", "consommation_lag_24h",
        lookback_days=40, min_rows=50, block_days=9,
    )
    days = backtest.fold_days(frame, "2023-05-25", "2023-12-01", HOURLY.tz)
    t = F.unix_seconds("date_heure")
    rows = days.join(
        frame, (t >= F.col("cutoff") - 40 * DAY) & (t + 24 * HOUR < F.col("cutoff"))
    ).withColumn("t", t)
    bounds = rows.groupBy("forecast_date").agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    rows = rows.join(bounds, "forecast_date").withColumn(
        "val", F.col("t") > F.col("lo") + F.floor((F.col("hi") - F.col("lo")) * F.lit(1 - 0.2))
    )
    brute = rows.groupBy("forecast_date").agg(
        F.min("date_heure").alias("t_min"),
        F.max("date_heure").alias("t_max"),
        F.count("*").alias("n_rows"),
        F.count_if(~F.col("val")).alias("n_train"),
        F.count_if("val").alias("n_val"),
        numeric.mean(
            F.when(F.col("val"), F.abs(F.expr("consommation - consommation_lag_24h"))), 2
        ).alias("val_mae"),
        (F.count("*") >= 50).alias("fit"),
    )
    assert ours.count() == brute.count() > 150
    assert ours.exceptAll(brute).count() == 0


def test_later_day_wins_a_slot_predicted_twice(spark):
    """In spring two anchors are 23 h apart and share an hour."""
    history = spark.sql(
        "SELECT timestamp'2024-03-15' + make_dt_interval(0, h) AS date_heure, 'A' AS region,"
        " CAST(h AS DOUBLE) AS consommation FROM (SELECT explode(sequence(0, 24 * 20)) AS h)"
    )
    hourly = spark.createDataFrame(
        [], "hour_dt timestamp, region string, temperature_celsius double,"
        " wind_speed_kmh double, solar_radiation_wm2 double"
    )
    keys = spark.createDataFrame([("A",)], "region string")
    rows = backtest.walk_forward_naive(
        history, hourly, keys, HOURLY, "2024-03-30", "2024-03-31"
    )
    assert rows.count() == 47
    shared = rows.filter("forecast_horizon_dt = timestamp'2024-03-31 04:00:00'").first()
    assert str(shared.forecast_date) == "2024-03-31"


def test_daily_grid_names():
    assert DAILY.slots_per_day == 1 and Grid().slots_per_day == 96
    assert Grid(value="load").rolling_name(168) == "load_rolling_168h"
