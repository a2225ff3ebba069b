from __future__ import annotations

import json

import pytest
from conftest import at

from slotcast.bindings import HOURLY
from slotcast.operators.validate import ContractError
from slotcast.plans import ingest_job
from slotcast.plans.feature_job import build_features, days_from, listing, materialize_incremental
from slotcast.schemas import TABLES
from slotcast.store import Store
from test_sources import hourly_page, record

NOW = "2024-06-02T00:00:00"


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def bodies(spark, *pages):
    rows = [(p if isinstance(p, str) else json.dumps(p),) for p in pages]
    return spark.createDataFrame(rows, "body string")


def values(store):
    return {(r.date_heure, r.region): r.consommation for r in store.read("consumption").collect()}


def test_first_run_then_overlap(store, spark):
    first = {"results": [record("2024-06-01T10:00:00Z", value=1.0), record("2024-05-20T10:00:00Z")]}
    ingest_job.run_ingest(store, HOURLY, bodies(spark, first), None, NOW)
    assert values(store) == {(at("2024-06-01T10:00:00"), "Normandie"): 1.0}
    assert ingest_job.start_of(store, "consumption", HOURLY, NOW)[:19] == "2024-06-01T04:00:00"
    again = {"results": [record("2024-06-01T10:00:00Z", value=2.0), record("2024-06-01T03:00:00Z"), record("2024-06-01T11:00:00Z", value=None)]}
    for _ in range(2):
        ingest_job.run_ingest(store, HOURLY, bodies(spark, again), None, "2024-06-02T01:00:00")
        assert values(store) == {(at("2024-06-01T10:00:00"), "Normandie"): 2.0}


BAD = [
    ({"error": "quota"}, "results_present"),
    ('{"results": [{"date_', "well_formed"),
    ({"results": [{"date_heure": "2024-06-01T10:00:00Z", "libelle_region": "X", "consommation": "much"}]}, "well_formed"),
    ({"results": [record("2024-06-01T10:00:00")]}, "time_has_zone"),
]


@pytest.mark.parametrize("page, rule", BAD)
def test_bad_pages_fail_or_are_set_aside(store, spark, page, rule):
    pages = bodies(spark, {"results": [record("2024-06-01T10:00:00Z")]}, page)
    with pytest.raises(ContractError) as error:
        ingest_job.run_ingest(store, HOURLY, pages, None, NOW)
    assert error.value.counts[rule] == 1
    assert values(store) == {}
    refused = ingest_job.run_ingest(store, HOURLY, pages, None, NOW, policy="quarantine")
    assert [rule in r["_reason"] for r in refused["consumption"].collect()] == [True]
    assert len(values(store)) == 1


def test_unequal_arrays_are_set_aside(store, spark):
    good = hourly_page(["2024-06-01T00:00", "2024-06-01T01:00"], [15.0, None])
    pages = bodies(spark, good, hourly_page(["2024-06-01T02:00", "2024-06-01T03:00"], [1.0]), {"region": "X"})
    refused = ingest_job.run_ingest(store, HOURLY, None, pages, NOW, policy="quarantine")
    assert refused["weather"].count() == 2
    assert store.read("weather").count() == 2


def test_unknown_policy_raises(store, spark):
    with pytest.raises(ValueError, match="unknown policy"):
        ingest_job.run_ingest(store, HOURLY, bodies(spark, {"results": []}), None, NOW, policy="drop")


def test_reingest_and_backfill(store, series):
    old = series([("2024-01-01T00:00:00", "A", 1.0), ("2024-05-31T00:00:00", "A", 1.0)])
    ingest_job.run_backfill(store, HOURLY, old, "2024-01-01T00:00:00", "2024-06-01T00:00:00")
    new = series([(t, "A", 5.0, NOW) for t in ("2024-01-01T00:00:00", "2024-05-31T00:00:00")])
    ingest_job.run_reingest(store, HOURLY, new, NOW)
    assert sorted(values(store).values()) == [1.0, 5.0]


def test_late_commits_and_old_corrections_reach_the_features(store, series, spark):
    store.append("weather", spark.createDataFrame([], TABLES["weather"].schema))
    days = [f"2024-01-{d:02d}T{h:02d}:00:00" for d in range(1, 29) for h in range(0, 24, 6)]
    store.upsert("consumption", series([(t, "A", 1.0, "2024-01-28T20:00:00") for t in days if t != days[-3]]))
    materialize_incremental(store, HOURLY, "2024-01-29T02:00:00", since="2023-12-31T00:00:00")
    # Stamped before the run, committed after it; and a correction three weeks back.
    store.upsert("consumption", series([(days[-3], "A", 7.0, "2024-01-29T01:59:00"), (days[8], "A", 9.0, "2024-01-29T01:00:00")]))
    materialize_incremental(store, HOURLY, "2024-01-29T03:00:00")
    full = build_features(store.read("consumption"), store.read("weather"), HOURLY)
    stored = store.read("features").select(*full.columns)
    assert stored.count() == full.count() == len(days)
    assert stored.exceptAll(full).count() == 0
    untouched = store.read("features").filter("_materialized_at < '2024-01-29T02:30:00'")
    assert {r.date_heure.day for r in untouched.collect()} == {1, 2, *range(11, 28)}
    assert len(listing(store)) == 28


def test_days_are_widened_once():
    assert days_from(["2024-01-01", "2024-01-02"], 1, 0) == ["2023-12-31", "2024-01-01", "2024-01-02"]
