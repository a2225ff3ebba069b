"""Every registered query runs; those with SQL give the same rows in another engine."""

from __future__ import annotations

import os

import pytest
from harness import compare, duck

import __spark_entry__ as entry

SF_DIR = os.environ.get("SLOTCAST_TEST_DIR", "/root/testdata/sf0.001")
QUERIES = entry.queries()
SQL = entry.oracle_sql()

# What needs more rows than the smallest scale has: runs, and slots that all keys reported.
LARGER_DIR = "/root/testdata/sf0.01"
LARGER = {
    "complete_slots", "national_metrics", "metrics_snapshot", "metrics_backfill", "recent_actuals",
    "next_slot_total", "kpi_strip", "write_predictions", "run_log_split", "full_rebuild_counts",
    "walk_forward_ledger",
}


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_oracle_has_its_query():
    assert set(SQL) <= set(QUERIES)
    assert len(QUERIES) >= 85


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, connection, name):
    if name in LARGER and SF_DIR.endswith("sf0.001"):
        assert compare(QUERIES[name](spark, LARGER_DIR), duck(LARGER_DIR), SQL[name]) == []
    else:
        assert compare(QUERIES[name](spark, SF_DIR), connection, SQL[name]) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "consommation_rolling_168h" in df.columns
