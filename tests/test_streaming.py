from __future__ import annotations

import pytest
from conftest import at
from pyspark.sql import functions as F

from slotcast.grid import Grid
from slotcast.operators.features import hourly_mean
from slotcast.operators.validate import ContractError
from slotcast.schemas import CONSUMPTION, WEATHER
from slotcast.store import Store
from slotcast.streaming import jobs

HOUR_GRID = Grid(step=3600)


def land(df, path, mode="append"):
    df.coalesce(1).write.mode(mode).parquet(str(path))


@pytest.fixture
def readings(spark):
    def make(rows):
        full = [(at(t), k, v, 1.0, 2.0, at(t)) for t, k, v in rows]
        return spark.createDataFrame(full, WEATHER)

    return make


def test_late_rows_are_upserted(spark, series, grid, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")

    def run():
        source = jobs.read_landed(spark, str(landing), CONSUMPTION)
        jobs.run_to_end(jobs.stream_upsert(source, store, "consumption", grid, checkpoint))
        return {(r.date_heure, r.region): r.consommation for r in store.read("consumption").collect()}

    land(series([("2024-01-02T00:00:00", "A", 1.0, "2024-01-02T01:00:00")]), landing)
    assert run() == {(at("2024-01-02T00:00:00"), "A"): 1.0}
    land(
        series(
            [
                ("2024-01-01T00:00:00", "A", 7.0, "2024-01-03T00:00:00"),
                ("2024-01-02T00:00:00", "A", 2.0, "2024-01-03T00:00:00"),
                ("2024-01-02T00:00:00", "A", 0.0, "2024-01-01T00:00:00"),
            ]
        ),
        landing,
    )
    expected = {(at("2024-01-01T00:00:00"), "A"): 7.0, (at("2024-01-02T00:00:00"), "A"): 2.0}
    assert run() == expected
    assert run() == expected


def test_broken_batch_stops_the_stream(spark, series, grid, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    land(series([("2024-01-02T00:00:00", "A", -1.0)]), tmp_path / "landing")
    source = jobs.read_landed(spark, str(tmp_path / "landing"), CONSUMPTION)
    rules = {"positive": F.col("consommation") > 0}
    with pytest.raises(Exception) as error:
        jobs.run_to_end(
            jobs.stream_upsert(
                source, store, "consumption", grid, str(tmp_path / "c"), rules=rules
            )
        )
    assert ContractError.__name__ in str(error.value)
    assert store.read("consumption").count() == 0


def test_closed_hours_equal_the_batch_means(spark, readings, tmp_path):
    rows = [(f"2024-01-01T{h:02d}:{m:02d}:00", k, float(h * m)) for h in range(24) for m in (0, 20, 40) for k in "AB"]
    df = readings(rows)
    land(df, tmp_path / "landing")
    source = jobs.read_landed(spark, str(tmp_path / "landing"), WEATHER)
    out = str(tmp_path / "out")
    jobs.run_to_end(
        jobs.write_files(jobs.stream_hourly(source, HOUR_GRID), out, str(tmp_path / "c"))
    )
    streamed = spark.read.parquet(out)
    closed = hourly_mean(df, HOUR_GRID).filter("hour_dt <= timestamp'2024-01-01 16:40:00'")
    assert streamed.count() == closed.count() == 17 * 2
    assert streamed.exceptAll(closed.select(*streamed.columns)).count() == 0


def test_rows_behind_the_watermark_are_left_out(spark, readings, tmp_path):
    landing, out, checkpoint = tmp_path / "landing", str(tmp_path / "out"), str(tmp_path / "c")

    def run():
        source = jobs.read_landed(spark, str(landing), WEATHER)
        stream = jobs.stream_hourly(source, HOUR_GRID)
        jobs.run_to_end(jobs.write_files(stream, out, checkpoint))

    land(readings([("2024-01-01T00:00:00", "A", 1.0), ("2024-01-01T12:00:00", "A", 1.0)]), landing)
    run()
    land(readings([("2024-01-01T00:30:00", "A", 9.0), ("2024-01-02T12:00:00", "A", 1.0)]), landing)
    run()
    values = {r.hour_dt: r.temperature_celsius for r in spark.read.parquet(out).collect()}
    assert values == {at("2024-01-01T00:00:00"): 1.0, at("2024-01-01T12:00:00"): 1.0}


def test_repeats_across_batches_are_dropped(spark, series, tmp_path):
    landing, out, checkpoint = tmp_path / "landing", str(tmp_path / "out"), str(tmp_path / "c")
    df = series([("2024-01-01T00:00:00", "A", 1.0), ("2024-01-01T00:15:00", "A", 2.0)])
    for _ in range(2):
        land(df, landing)
        source = jobs.read_landed(spark, str(landing), CONSUMPTION)
        once = jobs.stream_dedupe(source, "date_heure", ["date_heure", "region"])
        jobs.run_to_end(jobs.write_files(once, out, checkpoint))
    assert spark.read.parquet(out).count() == 2


def test_metrics_follow_each_batch(spark, series, tmp_path):
    from test_quality import predictions

    store = Store(spark, str(tmp_path / "store"))
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "c")
    store.append("predictions", predictions(spark, [("2024-01-01T00:00:00", k, 5.0) for k in "AB"]))

    def run():
        source = jobs.read_landed(spark, str(landing), CONSUMPTION)
        jobs.run_to_end(
            jobs.stream_metrics(source, store, Grid(), "2024-01-02T00:00:00", 2, checkpoint)
        )
        return {r.region: r.mae_mw for r in store.read("metrics").collect()}

    land(series([("2024-01-01T00:00:00", "A", 4.0)]), landing)
    assert run() == {"A": 1.0}
    land(series([("2024-01-01T00:00:00", "B", 8.0)]), landing)
    assert run() == {"A": 1.0, "B": 3.0, "France": 2.0}


def test_a_running_stream_takes_files_as_they_land(spark, series, grid, tmp_path):
    store, landing = Store(spark, str(tmp_path / "store")), tmp_path / "landing"
    land(series([("2024-01-02T00:00:00", "A", 1.0)]), landing)
    source = jobs.read_landed(spark, str(landing), CONSUMPTION)
    query = jobs.stream_upsert(
        source, store, "consumption", grid, str(tmp_path / "c"), trigger={"processingTime": "0 seconds"}
    )
    try:
        query.processAllAvailable()
        land(series([("2024-01-02T00:15:00", "A", 2.0)]), landing)
        query.processAllAvailable()
        assert query.isActive
        assert store.read("consumption").count() == 2
    finally:
        query.stop()
