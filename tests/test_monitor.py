from __future__ import annotations

from datetime import timedelta

from conftest import at
from pyspark.sql import functions as F
from test_quality import predictions

from slotcast.grid import Grid
from slotcast.operators import monitor

NOW = "2024-01-10T12:00:00"


def test_freshness_classes(spark):
    ages = {
        "continuous": [(19, "ok"), (20, "warn"), (59, "warn"), (60, "dead"), (None, "dead")],
        "daily": [(25.9 * 60, "ok"), (26 * 60, "warn"), (30 * 60, "dead"), (None, "dead")],
    }
    for cadence, cases in ages.items():
        for minutes, expected in cases:
            age = F.lit(None if minutes is None else minutes * 60.0).cast("double")
            row = spark.range(1).select(monitor.freshness_class(age, cadence).alias("c")).first()
            assert row.c == expected


def test_age_texts(spark):
    cases = {
        30.0: "just now", 59 * 60.0: "59 min ago", 61 * 60.0: "1 h 1 min ago",
        86400.0 * 3 + 5: "3 d ago", None: "—",
    }
    df = spark.createDataFrame([(a,) for a in cases], "age double")
    rows = df.select("age", monitor.age_text(F.col("age")).alias("t")).collect()
    assert {r.age: r.t for r in rows} == cases


def test_status_row(spark, series):
    empty = series([])
    full = series([("2024-01-10T11:50:00", "A", 1.0)])
    status = monitor.system_status(
        {"ingest": (full, "date_heure"), "features": (empty, "date_heure")}
    )
    assert tuple(status.first()) == (at("2024-01-10T11:50:00"), None)
    rows = {r["name"]: r["class"] for r in monitor.freshness(status, NOW).collect()}
    assert rows == {"ingest": "ok", "features": "dead"}


def test_next_slot(spark, grid):
    pred = predictions(
        spark,
        [(NOW, "A", 99.0), ("2024-01-10T12:15:00", "A", 1.0), ("2024-01-10T12:15:00", "B", 2.0),
         ("2024-01-10T12:30:00", "A", 50.0)],
    )
    assert monitor.next_slot_total(pred, grid, NOW).first().total_mw == 3.0
    assert monitor.next_slot_total(pred, grid, "2025-01-01T00:00:00").first().total_mw is None


def test_completeness_counts_slots_once(series, grid):
    rows = [("2024-01-10T00:00:00", "A", 1.0)] * 3 + [("2024-01-10T00:15:00", "A", None)]
    row = monitor.completeness(series(rows), grid, NOW, 1).first()
    assert (row.n_slots, row.pct) == (1, 1.0)


def test_day_view_aligns_three_series(spark, series, grid):
    actual = series(
        [("2024-01-10T00:00:00", "A", 5.0), ("2024-01-09T00:00:00", "A", 4.0),
         ("2024-01-09T00:15:00", "A", 3.0), ("2024-01-10T00:00:00", "B", 1.0)]
    )
    pred = predictions(spark, [("2024-01-10T00:00:00", "A", 6.0), ("2024-01-11T00:00:00", "A", 9.0)])
    rows = monitor.day_view(pred, actual, grid, NOW).collect()
    assert [tuple(r) for r in rows] == [
        (at("2024-01-10T00:00:00"), 6.0, 6.0, 4.0),
        (at("2024-01-10T00:15:00"), None, None, 3.0),
    ]
    only_a = monitor.day_view(pred, actual, grid, NOW, key="A").first()
    assert only_a.actual == 5.0


def test_heatmap_is_by_local_hour(spark, grid):
    pred = predictions(
        spark,
        [("2024-01-10T23:00:00", "Normandie", 1.0), ("2024-01-10T23:30:00", "Normandie", 3.0),
         ("2024-01-10T12:00:00", "Grand Est", 9.0),
         ("2024-01-10T12:00:00", "Provence-Alpes-Côte d'Azur", 1.0)],
    )
    rows = monitor.hour_heatmap(pred, grid).collect()
    assert [r.label for r in rows] == ["Grand Est", "Normandie", "PACA"]
    assert rows[1].h00 == 2.0 and rows[1].h13 is None and rows[0].h13 == 9.0


def test_ranking_and_history(spark):
    base = at("2024-01-01T00:00:00").date()
    rows = [
        (base + timedelta(days=d), k, float(v), 1.0, 1.0, 5, at(NOW))
        for d, k, v in [(0, "A", 9), (1, "A", 3), (1, "B", 2), (1, "France", 1), (1, "C", 0)]
    ]
    rows[-1] = (*rows[-1][:2], None, *rows[-1][3:])
    df = spark.createDataFrame(
        rows,
        "computed_date date, region string, mae_mw double, p95_error_mw double,"
        " p99_error_mw double, n_samples long, _computed_at timestamp",
    )
    assert [r.region for r in monitor.mae_ranking(df, "region").collect()] == ["B", "A"]
    assert monitor.latest_metrics(df, "region").count() == 4
    assert monitor.metrics_history(df, "region", "2024-02-01").count() == 4


def test_smoke_checks_count_failures(spark, series, grid):
    raw = series([("2024-01-10T11:00:00", "A", 1.0)])
    pred = predictions(spark, [("2024-01-08T23:00:00", "A", 1.0)])
    rows = {r["check"]: r for r in monitor.smoke_checks(raw, pred, grid, NOW).collect()}
    assert rows["raw_fresh"].ok and not rows["predictions_recent"].ok
    assert rows["raw_fresh"].failures == 1


def test_empty_model_version(spark):
    df = predictions(spark, []).limit(0)
    row = monitor.latest_batch(df).first()
    assert (row.forecasted_at, row.model) == (None, "")
    assert Grid().step == 900
