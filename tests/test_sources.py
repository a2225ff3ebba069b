from __future__ import annotations

import json

import pytest
from conftest import at
from pyspark.sql import functions as F

from slotcast.grid import Grid
from slotcast.operators import validate
from slotcast.sources import dimensions, incremental, landed, periods



def now():
    return F.lit("2024-06-01T00:00:00").cast("timestamp")


def write(folder, *pages):
    for i, page in enumerate(pages):
        (folder / f"page{i}.json").write_text(json.dumps(page), encoding="utf-8")
    return str(folder)


def record(time, region="Normandie", value=1.0):
    return {"date_heure": time, "libelle_region": region, "consommation": value}


def test_records_are_normalised_to_utc(spark, grid, tmp_path):
    path = write(
        tmp_path,
        {"results": [record("2024-06-01T10:00:00+02:00"), record("2024-06-01T10:00:00+00:00", value=None)]},
        {"results": []},
        {"results": [record("2024-06-01T12:00:00Z", "Île-de-France", 5)]},
    )
    pages = landed.read_record_pages(spark, path)
    validate.validate(pages, validate.record_page_rules())
    rows = landed.normalise_records(landed.explode_records(pages), grid, now())
    assert rows.columns == ["date_heure", "region", "consommation", "_ingested_at"]
    assert {(r.date_heure, r.region, r.consommation) for r in rows.collect()} == {
        (at("2024-06-01T08:00:00"), "Normandie", 1.0),
        (at("2024-06-01T12:00:00"), "Île-de-France", 5.0),
    }
    later = landed.normalise_records(
        landed.explode_records(pages), grid, now(), since="2024-06-01T08:00:00"
    )
    assert later.count() == 1


@pytest.mark.parametrize(
    "page, rule",
    [
        ({"results": [record("2024-06-01T10:00:00")]}, "time_has_zone"),
        ({"results": [record(None)]}, "time_has_zone"),
        ({"results": [record("yesterday+02:00")]}, "time_parses"),
        ({"total_count": 0}, "results_present"),
        ({"results": [record("2024-06-01T10:00:00Z", None)]}, "region_present"),
    ],
)
def test_bad_pages_fail(spark, tmp_path, page, rule):
    path = write(tmp_path, {"results": [record("2024-06-01T10:00:00Z")]}, page)
    with pytest.raises(validate.ContractError) as error:
        validate.validate(landed.read_record_pages(spark, path), validate.record_page_rules())
    assert error.value.counts[rule] == 1


def hourly_page(times, temperature, region="Normandie"):
    n = len(times)
    return {
        "region": region,
        "hourly": {
            "time": times,
            "temperature_2m": temperature,
            "wind_speed_10m": [None] * n,
            "direct_radiation": [0.0] * n,
        },
    }


def test_hourly_arrays(spark, grid, tmp_path):
    path = write(tmp_path, hourly_page(["2024-06-01T00:00", "2024-06-01T01:00"], [15.0, None]))
    pages = landed.read_hourly_pages(spark, path)
    validate.validate(pages, validate.hourly_page_rules())
    rows = landed.explode_hourly(pages, grid, now()).orderBy("date_heure").collect()
    assert [(r.date_heure, r.temperature_celsius, r.wind_speed_kmh) for r in rows] == [
        (at("2024-06-01T00:00:00"), 15.0, None),
        (at("2024-06-01T01:00:00"), None, None),
    ]
    assert landed.explode_hourly(pages, grid, now(), since="2024-06-01T00:00:00").count() == 1


@pytest.mark.parametrize(
    "page, rule",
    [
        (hourly_page(["2024-06-01T00:00", "2024-06-01T01:00"], [15.0]), "temperature_2m_length"),
        ({"region": "Normandie"}, "hourly_present"),
    ],
)
def test_unequal_or_missing_arrays_fail(spark, tmp_path, page, rule):
    pages = landed.read_hourly_pages(spark, write(tmp_path, page))
    with pytest.raises(validate.ContractError) as error:
        validate.validate(pages, validate.hourly_page_rules())
    assert rule in error.value.counts


def test_regions_are_indexed_by_name(spark):
    rows = dimensions.region_dim(spark).orderBy("region_idx").collect()
    assert [r.region for r in rows] == dimensions.REGION_LABELS
    assert len(rows) == 12
    derived = dimensions.category_index(dimensions.region_dim(spark), "region")
    assert {tuple(r) for r in derived.collect()} == {(r.region, r.region_idx) for r in rows}


def test_periods(spark):
    bounds = spark.sql("SELECT date'2023-11-15' AS start_date, date'2024-02-03' AS end_date")
    months = periods.plan_periods(bounds, "month").orderBy("period_start").collect()
    assert [(str(r[0]), str(r[1])) for r in months] == [
        ("2023-11-01", "2023-12-01"),
        ("2023-12-01", "2024-01-01"),
        ("2024-01-01", "2024-02-01"),
        ("2024-02-01", "2024-03-01"),
    ]
    years = periods.plan_periods(bounds, "year").orderBy("period_start").collect()
    assert [(str(r[0]), str(r[1])) for r in years] == [
        ("2023-11-15", "2023-12-31"),
        ("2024-01-01", "2024-02-03"),
    ]
    with pytest.raises(ValueError):
        periods.plan_periods(bounds, "week")


def test_first_run_falls_back_to_seven_days(series):
    mark = incremental.high_water_mark(series([]), "date_heure")
    assert mark.first().hwm is None
    since = incremental.since_with_overlap(mark, "2024-01-31T00:00:00").first().since
    assert since == at("2024-01-24T00:00:00")
    mark = incremental.high_water_mark(series([("2024-01-30T12:00:00", "A", 1.0)]), "date_heure")
    since = incremental.since_with_overlap(mark, "2024-01-31T00:00:00").first().since
    assert since == at("2024-01-30T06:00:00")


def test_preferred_feed_wins_even_if_older(series):
    consolidated = series([("2024-01-01T00:00:00", "A", 1.0, "2024-01-01T00:00:00")])
    realtime = series(
        [
            ("2024-01-01T00:00:00", "A", 2.0, "2024-02-01T00:00:00"),
            ("2024-01-01T00:15:00", "A", 3.0, "2024-02-01T00:00:00"),
        ]
    )
    rows = incremental.prefer_source([consolidated, realtime], Grid()).collect()
    assert sorted(r.consommation for r in rows) == [1.0, 3.0]


def test_backfill_is_half_open(series, grid, spark):
    df = series(
        [
            ("2024-01-01T00:00:00", "A", 1.0),
            ("2024-02-01T00:00:00", "A", 1.0),
            ("2024-01-05T00:00:00", "A", None),
            ("2024-01-05T00:00:00", "B", 2.0),
        ]
    )
    only_a = spark.createDataFrame([("A",)], "region string")
    out = landed.read_backfill(df, grid, "2024-01-01T00:00:00", "2024-02-01T00:00:00", only_a)
    assert [r.date_heure for r in out.collect()] == [at("2024-01-01T00:00:00")]
