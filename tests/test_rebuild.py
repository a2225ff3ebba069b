"""The step journal, and a rebuild that is killed between its steps."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from slotcast.grid import Grid
from slotcast.plans import rebuild, training_job
from slotcast.plans.journal import JOURNAL, Journal
from slotcast.store import Store

HOURLY = Grid(step=3600)
SINCE, AS_OF, DAY = "2024-01-08T00:00:00", "2024-01-25T00:00:00", "2024-01-24"


@pytest.fixture(scope="module")
def feeds(spark):
    """24 days of two hourly series in two feeds, and readings."""
    rows = spark.sql(
        """SELECT timestamp'2024-01-01' + make_dt_interval(0, h) AS date_heure, region,
        100D + h % 24 + IF(region = 'A', 50, 0) AS consommation, timestamp'2024-02-01' AS _ingested_at
        FROM (SELECT explode(sequence(0, 575)) AS h), (SELECT explode(array('A', 'B')) AS region)"""
    ).persist()
    readings = rows.select(
        "date_heure", "region", F.lit(5.0).alias("temperature_celsius"), F.lit(1.0).alias("wind_speed_kmh"),
        F.lit(2.0).alias("solar_radiation_wm2"), "_ingested_at",
    )
    return [rows.filter("region = 'A'"), rows.filter("region = 'B'")], readings


def build(store, feeds, **options):
    return rebuild.full_rebuild(
        store, HOURLY, feeds[0], feeds[1], ["A", "B"], SINCE, AS_OF, DAY, run="r", rounds=2, **options
    )


def noted(store):
    rows = store.spark.read.schema(JOURNAL).parquet(f"{store.root}/journal").orderBy("finished_at").collect()
    return [r.step for r in rows]


STEPS = ["truncate", "consumption", "weather", "features", "train", "forecast"]


def test_a_killed_rebuild_goes_on_with_the_open_step(spark, feeds, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    calls, train = [], rebuild.train

    def dying(*args, **options):
        calls.append("train")
        if len(calls) == 1:
            raise RuntimeError("killed")
        return train(*args, **options)

    monkeypatch.setattr(rebuild, "train", dying)
    with pytest.raises(RuntimeError):
        build(store, feeds)
    assert noted(store) == STEPS[:4]
    loads = []
    monkeypatch.setattr(rebuild, "run_backfill", lambda *a, **k: loads.append(1))
    run_id = build(store, feeds)
    assert noted(store) == STEPS and loads == []
    assert store.read("predictions").select("model_version").distinct().collect() == [(run_id,)]
    assert store.read("predictions").count() == 48
    # All done: the same result, and nothing is run again.
    assert build(store, feeds) == run_id and calls == ["train", "train"]
    assert training_job.read_runs(spark, f"{store.root}/runs").count() == 1


def test_a_step_is_repeated_where_its_tables_have_changed(spark, feeds, tmp_path):
    store, done = Store(spark, str(tmp_path)), []

    def run():
        journal = Journal(store, "x")
        journal.step("load", lambda: done.append("load"))
        journal.step("use", lambda: done.append("use"), ["consumption"])
        return journal.step("last", lambda: done.append("last") or "result")

    assert run() == "result" and run() == "result"
    assert done == ["load", "use", "last"]
    store.append("consumption", feeds[0][0].limit(3))
    run()
    assert done == ["load", "use", "last", "use", "last"]


def test_bounds_and_keys_of_the_archive(spark, feeds, tmp_path):
    store = Store(spark, str(tmp_path))
    keys = spark.createDataFrame([("A",)], "region string")
    build(store, feeds, start="2024-01-03T00:00:00", keys=keys)
    low, high, n = store.read("consumption").agg(F.min("date_heure"), F.max("date_heure"), F.countDistinct("region")).first()
    assert (str(low), str(high), n) == ("2024-01-03 00:00:00", "2024-01-24 23:00:00", 1)
