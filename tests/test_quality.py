from __future__ import annotations

from conftest import at
from pyspark.sql import functions as F

from slotcast.grid import Grid
from slotcast.operators import quality
from slotcast.plans import metrics_job
from slotcast.store import Store

PAIR = "forecast_horizon_dt timestamp, region string, predicted_mw double, consommation double"


def test_percentiles_interpolate(spark, grid):
    rows = [(at("2024-01-01T00:00:00"), "A", float(e), 0.0) for e in range(1, 101)]
    row = quality.key_metrics(spark.createDataFrame(rows, PAIR), grid).first()
    assert (row.mae_mw, row.n_samples) == (50.5, 100)
    assert round(row.p95_error_mw, 9) == 95.05
    assert round(row.p99_error_mw, 9) == 99.01


def test_national_error_is_of_the_sum(spark, grid):
    rows = [
        (at("2024-01-01T00:00:00"), "A", 10.0, 12.0),
        (at("2024-01-01T00:00:00"), "B", 20.0, 18.0),
        (at("2024-01-01T00:15:00"), "A", 50.0, 10.0),
    ]
    df = spark.createDataFrame(rows, PAIR)
    row = quality.national_metrics(df, grid, 2).first()
    assert (row.region, row.mae_mw, row.n_samples) == ("France", 0.0, 1)
    first_slot = df.filter("forecast_horizon_dt = timestamp'2024-01-01 00:00:00'")
    assert {r.mae_mw for r in quality.key_metrics(first_slot, grid).collect()} == {2.0}
    assert quality.national_metrics(df, grid, 3).count() == 0


def predictions(spark, rows):
    return spark.createDataFrame(
        [(at(t), k, p, "v1", at(t).date(), at(t)) for t, k, p in rows],
        "forecast_horizon_dt timestamp, region string, predicted_mw double, model_version string,"
        " forecast_date date, forecasted_at timestamp",
    )


def test_matching_window_and_repeats(spark, series, grid):
    as_of = "2024-01-10T12:00:00"
    slots = {
        "2024-01-03T12:00:00": True,
        "2024-01-03T11:45:00": False,
        "2024-01-10T10:00:00": True,
        "2024-01-10T10:15:00": False,
    }
    pred = predictions(spark, [(t, "A", 1.0) for t in slots])
    raw = series([(t, "A", 2.0) for t in slots] + [("2024-01-03T12:00:00", "A", 3.0, "2024-07-01T00:00:00")])
    rows = quality.match_actuals(pred, raw, grid, as_of).collect()
    assert {r.forecast_horizon_dt for r in rows} == {at(t) for t, ok in slots.items() if ok}
    assert len(rows) == 2
    assert {r.consommation for r in rows} == {2.0, 3.0}


def test_backfill_equals_single_snapshots(spark, series, grid):
    times = [f"2024-01-0{d}T{h:02d}:00:00" for d in range(1, 10) for h in (0, 6, 12, 22)]
    pred = predictions(spark, [(t, k, float(i)) for i, t in enumerate(times) for k in "AB"])
    raw = series([(t, k, float(i * 3 % 7)) for i, t in enumerate(times) for k in "AB"])
    whole = quality.metrics_backfill(
        quality.match_all(pred, raw, grid), grid, 2, "2024-01-02", "2024-01-15"
    )
    for day in ("2024-01-02", "2024-01-05", "2024-01-09", "2024-01-15"):
        as_of = f"{day}T00:00:00"
        single = quality.metrics_snapshot(
            quality.match_actuals(pred, raw, grid, as_of), grid, 2, F.lit(day), F.lit(as_of)
        )
        ours = whole.filter(F.col("computed_date") == F.lit(day).cast("date"))
        assert ours.count() == single.count() > 0
        assert ours.exceptAll(single).count() == 0
    assert whole.filter("computed_date > date'2024-01-16'").count() == 0


def test_alert(spark):
    df = spark.createDataFrame([("France", 401.0), ("France", 400.0), ("A", 900.0)], "region string, mae_mw double")
    assert [r.mae_mw for r in quality.mae_alert(df, "region").collect()] == [401.0]


def test_metrics_job_is_repeatable(spark, series, tmp_path):
    grid, store = Grid(), Store(spark, str(tmp_path))
    store.append("consumption", series([("2024-01-01T00:00:00", k, 10.0) for k in "AB"]))
    store.append("predictions", predictions(spark, [("2024-01-01T00:00:00", k, 12.0) for k in "AB"]))
    for _ in range(2):
        metrics_job.run_metrics(store, grid, "2024-01-02T00:00:00", 2, tz="Europe/Paris")
    rows = store.read("metrics").collect()
    assert {(r.region, r.mae_mw) for r in rows} == {("A", 2.0), ("B", 2.0), ("France", 4.0)}
    assert len(rows) == 3
    assert metrics_job.alerts(store, grid, 3.0).count() == 1
