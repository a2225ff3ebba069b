from __future__ import annotations

import random
from datetime import timedelta

from conftest import at
from pyspark.sql import functions as F

from slotcast.bindings import HOURLY
from slotcast.grid import Grid
from slotcast.operators import horizon
from slotcast.operators.features import history_features
from slotcast.plans.forecast_job import forecast_frame, history_as_known, known_history


def hourly_rows(series, days=30, keep=0.85, keys=("A", "B")):
    rng = random.Random(5)
    start = at("2024-03-10T00:00:00")
    return series(
        [
            ((start + timedelta(hours=h)).isoformat(), k, round(rng.uniform(1, 90), 2))
            for k in keys
            for h in range(days * 24)
            if rng.random() < keep
        ]
    ).select("date_heure", "region", "consommation")


def keys_of(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "region string")


def test_always_96_slots_on_clock_change_days(spark):
    days = horizon.day_range(spark, "2024-03-30", "2024-10-26").filter(
        "forecast_date IN (date'2024-03-30', date'2024-10-26')"
    )
    rows = (
        horizon.horizon_slots(days, Grid())
        .groupBy("forecast_date")
        .agg(F.count("*"), F.min("forecast_horizon_dt"), F.max("forecast_horizon_dt"))
        .orderBy("forecast_date")
        .collect()
    )
    assert [tuple(r)[1:] for r in rows] == [
        (96, at("2024-03-30T05:00:00"), at("2024-03-31T04:45:00")),
        (96, at("2024-10-26T04:00:00"), at("2024-10-27T03:45:00")),
    ]


def test_scaffold_has_every_key_without_history(spark):
    slots = horizon.scaffold(keys_of(spark, "A", "B", "C"), "2024-03-01", "2024-03-02", Grid())
    assert slots.count() == 3 * 2 * 96


def test_fallback(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0), (None, 2.0), (None, None)],
        "consommation_lag_24h double, consommation_lag_48h double",
    )
    out = horizon.lag_fallback(df, Grid())
    assert [r.consommation_lag_24h for r in out.collect()] == [1.0, 2.0, None]
    assert tuple(horizon.fallback_count(out).first()) == (3, 1)


def test_aligned_rolling_equals_a_range_join(spark, series):
    history = hourly_rows(series)
    slots = horizon.scaffold(keys_of(spark, "A", "B"), "2024-03-12", "2024-04-08", HOURLY)
    ours = horizon.aligned_rolling(slots, history, HOURLY).select(
        "forecast_date", "forecast_horizon_dt", "region", "consommation_rolling_168h"
    )
    h = history.withColumnRenamed("region", "r")
    joined = slots.join(
        h,
        (h.r == slots.region)
        & (h.date_heure >= slots.forecast_horizon_dt - F.expr("INTERVAL 192 HOUR"))
        & (h.date_heure <= slots.forecast_horizon_dt - F.expr("INTERVAL 25 HOUR")),
        "left",
    )
    brute = joined.groupBy("forecast_date", "forecast_horizon_dt", "region").agg(
        (F.sum(F.rint(F.col("consommation") * 100).cast("long")) / 100.0 / F.nullif(F.count("consommation"), F.lit(0))).alias("r")
    )
    assert ours.count() == brute.count()
    assert ours.exceptAll(brute).count() == 0


def test_serving_equals_training(spark, series):
    """The frame at slot S holds what the feature row at S - 24 h holds."""
    history = hourly_rows(series)
    names = ["consommation_lag_48h", "consommation_lag_168h", "consommation_rolling_168h"]
    frame = forecast_frame(
        history,
        spark.createDataFrame(
            [], "hour_dt timestamp, region string, temperature_celsius double,"
            " wind_speed_kmh double, solar_radiation_wm2 double"
        ),
        keys_of(spark, "A", "B"),
        "2024-03-22",
        "2024-04-05",
        HOURLY,
    ).filter("NOT used_fallback")
    served = frame.select(
        (F.col("forecast_horizon_dt") - F.expr("INTERVAL 24 HOUR")).alias("date_heure"),
        "region", "consommation_lag_24h", *names,
    )
    trained = history_features(history, HOURLY).select(
        "date_heure", "region", "consommation_lag_24h", *names
    )
    both = served.alias("s").join(trained.alias("t"), ["date_heure", "region"])
    assert both.count() > 500
    different = both.filter(
        " OR ".join(f"NOT (s.{n} <=> t.{n})" for n in ["consommation_lag_24h", *names])
    )
    assert different.count() == 0


def test_history_after_the_anchor_is_not_used(spark, series):
    history = hourly_rows(series)
    known = known_history(history, "2024-03-25", "2024-03-25", HOURLY)
    assert known.agg(F.max("date_heure")).first()[0] < at("2024-03-25T05:00:00")
    late = known_history(
        history, "2024-03-25", "2024-03-25", HOURLY, publication_lag_hours=7
    )
    assert late.agg(F.max("date_heure")).first()[0] < at("2024-03-24T22:00:00")


def test_a_correction_after_the_anchor_is_not_known(series):
    """06:00 in Paris on 25 March 2024 is 05:00 UTC."""
    raw = series(
        [
            ("2024-03-24T00:00:00", "A", 1.0, "2024-03-24T01:00:00"),
            ("2024-03-24T00:00:00", "A", 9.0, "2024-03-25T05:00:01"),
            ("2024-03-24T23:00:00", "A", 5.0, "2024-03-25T06:00:00"),
            ("2024-03-01T00:00:00", "A", 7.0, "2024-03-01T01:00:00"),
        ]
    )
    rows = history_as_known(raw, "2024-03-25", "2024-03-26", HOURLY).collect()
    known = {(str(r.forecast_date), r.date_heure): r.consommation for r in rows}
    assert known == {
        ("2024-03-25", at("2024-03-24T00:00:00")): 1.0,
        ("2024-03-26", at("2024-03-24T00:00:00")): 9.0,
        ("2024-03-26", at("2024-03-24T23:00:00")): 5.0,
    }


def test_each_day_sees_one_version_as_it_stood_at_its_anchor(spark, series):
    """Corrections, ties and late records: against the newest arrived record, day by day."""
    from slotcast.grid import Grid
    from slotcast.plans.forecast_job import history_as_known

    grid = Grid(step=3600)
    rows = []
    for h in range(0, 96, 3):
        slot = f"2024-01-{1 + h // 24:02d}T{h % 24:02d}:00:00"
        for k, lag in enumerate((1, 30, 30, 75)[: 1 + h % 4]):
            at = h + lag + k % 2
            rows.append((slot, "A", float(10 * h + k), f"2024-01-{1 + at // 24:02d}T{at % 24:02d}:30:00"))
    raw = series(rows)
    got = history_as_known(raw, "2024-01-02", "2024-01-08", grid, lookback_hours=72).collect()
    found = {(str(r.forecast_date), str(r.date_heure)): r.consommation for r in got}
    assert len(found) == len(got)
    want = {}
    for d in range(2, 9):
        anchor = f"2024-01-{d:02d} 05:00:00"
        for r in sorted(raw.collect(), key=lambda r: (r._ingested_at, r.consommation)):
            low = f"2024-01-{d - 3:02d} 05:00:00" if d > 3 else ""
            if str(r._ingested_at) <= anchor and low <= str(r.date_heure) < anchor:
                want[f"2024-01-{d:02d}", str(r.date_heure)] = r.consommation
    assert found == want and len(want) > 50
