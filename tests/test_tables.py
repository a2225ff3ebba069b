from __future__ import annotations

from datetime import date, timedelta
from pathlib import Path

import pytest
from conftest import at
from pyspark.sql import functions as F

from slotcast.bindings import HOURLY
from slotcast.operators import tables
from slotcast.plans.feature_job import build_features, materialize_incremental
from slotcast.schemas import FEATURES, TABLES
from slotcast.store import Store
from test_features import WEATHER


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def contents(store, name="consumption"):
    return {(r.date_heure, r.region): r.consommation for r in store.read(name).collect()}


def files(store, day):
    return sorted(p.name for p in Path(store.path("consumption"), f"day={day}").glob("*.parquet"))


def test_upsert_updates_inserts_and_keeps(store, series):
    store.upsert("consumption", series([("2024-01-01T00:00:00", "A", 1.0), ("2024-01-02T00:00:00", "A", 2.0)]))
    before = files(store, "2024-01-01")
    batch = series([("2024-01-02T00:00:00", "A", 9.0), ("2024-01-02T00:15:00", "B", 3.0)])
    for _ in range(2):
        store.upsert("consumption", batch)
        assert contents(store) == {
            (at("2024-01-01T00:00:00"), "A"): 1.0,
            (at("2024-01-02T00:00:00"), "A"): 9.0,
            (at("2024-01-02T00:15:00"), "B"): 3.0,
        }
    assert files(store, "2024-01-01") == before


@pytest.mark.parametrize("key", ["A", None])
def test_repeated_and_null_keys_raise(store, spark, key):
    rows = [(at("2024-01-01T00:00:00"), key, 1.0, at("2024-01-01T00:00:00"))] * (2 if key else 1)
    df = spark.createDataFrame(
        rows, "date_heure timestamp, region string, consommation double, _ingested_at timestamp"
    )
    with pytest.raises(ValueError):
        store.upsert("consumption", df)
    assert store.read("consumption").count() == 0


def test_partial_batch_keeps_other_columns(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    rows = {tuple(r) for r in tables.upsert_rows(old, new, ["k"]).collect()}
    assert rows == {(1, "a", "x"), (2, "B", "y"), (3, "C", None)}


def test_older_record_does_not_replace_a_newer_one(store, series):
    store.upsert("consumption", series([("2024-01-01T00:00:00", "A", 2.0, "2024-01-03T00:00:00")]))
    late = series([("2024-01-01T00:00:00", "A", 1.0, "2024-01-02T00:00:00")])
    store.upsert("consumption", late, newest_by="_ingested_at")
    assert list(contents(store).values()) == [2.0]


def test_interrupted_swap_can_be_published_again(store, series, spark, monkeypatch):
    store.upsert("consumption", series([("2024-01-01T00:00:00", "A", 1.0)]))
    real, staged = tables.publish, []

    def broken(spark_, folder, path, layout):
        staged.append(folder)
        raise OSError("lost")

    monkeypatch.setattr(tables, "publish", broken)
    with pytest.raises(OSError) as error:
        store.upsert("consumption", series([("2024-01-01T00:00:00", "A", 5.0)]))
    assert staged[0] in error.value.__notes__[0]
    assert list(contents(store).values()) == [1.0]
    real(spark, staged[0], store.path("consumption"), TABLES["consumption"])
    assert list(contents(store).values()) == [5.0]


def test_required_columns_are_enforced_on_append(store, spark):
    df = spark.createDataFrame(
        [(at("2024-01-01T00:00:00"), "A", 1.0, None)],
        "date_heure timestamp, region string, consommation double, _ingested_at timestamp",
    )
    with pytest.raises(Exception, match="_ingested_at"):
        store.append("consumption", df)
    assert store.read("consumption").count() == 0
    with pytest.raises(ValueError, match="columns missing"):
        store.append("consumption", df.drop("region"))


def test_day_filter_prunes_partitions(store, series, spark):
    store.append("consumption", series([(f"2024-01-0{d}T00:00:00", "A", 1.0) for d in range(1, 8)]))
    part = store.read("consumption", "2024-01-03", "2024-01-04")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert part.count() == 2


def test_hot_day_is_not_one_task(spark, series):
    """The day is gathered by a rebalance, which adaptive execution may split."""
    df = series([("2024-01-01T00:00:00", "A", 1.0)])
    layout = TABLES["consumption"]
    plan = tables.arrange(tables.conform(df, layout), layout)._jdf.queryExecution()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan.executedPlan().toString()


def test_retention(store, series):
    store.append("consumption", series([(f"2024-01-{d:02d}T05:00:00", "A", 1.0) for d in range(1, 11)]))
    limit = (date(2024, 1, 4) + timedelta(days=730)).isoformat()
    df = store.read("consumption")
    kept = tables.expire(df, "date_heure", f"{limit}T00:00:00", 730).count()
    expired = tables.expired_days(df, "date_heure", f"{limit}T00:00:00", 730).count()
    assert (kept, expired) == (6, 4)
    dropped = store.drop_expired(f"{limit}T00:00:00")["consumption"]
    assert dropped == [f"2024-01-{d:02d}" for d in range(1, 5)]
    assert store.read("consumption").count() == 6
    assert tables.expire(df, "date_heure", limit, None) is df


def test_truncate_keeps_the_schema(store, series):
    store.append("consumption", series([("2024-01-01T00:00:00", "A", 1.0)]))
    store.truncate()
    for name, layout in TABLES.items():
        assert store.read(name).count() == 0
        assert store.read(name).columns == layout.schema.fieldNames()


def test_feature_registry_metadata():
    fields = [f for f in FEATURES.fields if "lag" in f.name]
    assert len(fields) == 3 and all(f.metadata["source"] == "consumption" for f in fields)


def hourly(series, first, last, value, stamp):
    rows = []
    moment = at(first)
    while moment <= at(last):
        rows.append((moment.isoformat(), "A", value(moment), stamp))
        moment += timedelta(hours=1)
    return series(rows)


def test_correction_reaches_every_row_it_can_change(store, series, spark):
    value = lambda t: float((t.day * 24 + t.hour) % 37)
    store.append("weather", spark.createDataFrame([], TABLES["weather"].schema))
    store.upsert(
        "consumption",
        hourly(series, "2024-01-01T00:00:00", "2024-01-25T00:00:00", value, "2024-01-25T01:00:00"),
    )
    materialize_incremental(store, HOURLY, "2024-01-25T02:00:00", since="2023-12-31T00:00:00")
    before = {r.date_heure: r for r in store.read("features").collect()}
    changed_at = at("2024-01-10T05:00:00")
    store.upsert("consumption", series([(changed_at.isoformat(), "A", 999.0, "2024-01-26T00:00:00")]))
    materialize_incremental(store, HOURLY, "2024-01-26T01:00:00")
    after = {r.date_heure: r for r in store.read("features").collect()}
    names = [f"consommation_lag_{h}h" for h in (24, 48, 168)] + ["consommation_rolling_168h"]
    moved = {t for t in after if any(before[t][n] != after[t][n] for n in names)}
    reach = {changed_at + timedelta(hours=h) for h in range(1, 169)}
    assert moved == reach
    full = build_features(
        store.read("consumption"),
        spark.createDataFrame([], WEATHER + ", _ingested_at timestamp"),
        HOURLY,
    )
    stored = store.read("features").drop("_materialized_at").select(*full.columns)
    assert stored.count() == full.count()
    assert stored.exceptAll(full).count() == 0


def test_reference_mode_only_goes_forward(store, series, spark):
    store.append("weather", spark.createDataFrame([], TABLES["weather"].schema))
    value = lambda t: float(t.hour)
    store.upsert("consumption", hourly(series, "2024-01-01T00:00:00", "2024-01-05T00:00:00", value, "2024-01-05T01:00:00"))
    materialize_incremental(store, HOURLY, "2024-01-05T02:00:00")
    n = store.read("features").count()
    store.upsert("consumption", hourly(series, "2024-01-05T01:00:00", "2024-01-05T06:00:00", value, "2024-01-05T07:00:00"))
    materialize_incremental(store, HOURLY, "2024-01-05T08:00:00", mode="reference")
    assert store.read("features").count() == n + 6
    materialize_incremental(store, HOURLY, "2024-01-05T09:00:00")
    assert store.read("features").filter(F.col("_materialized_at") > F.lit("2024-01-05T08:30:00").cast("timestamp")).count() == 0
