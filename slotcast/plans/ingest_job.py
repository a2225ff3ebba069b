"""The jobs that bring landed pages and archives into the tables.

A page that breaks its contract fails the job (``policy='fail'``), or is set aside with the
names of the broken rules (``'quarantine'``; malformed text is kept) while the good pages go on.
All jobs upsert by key with the newest ingestion winning, so repeats and re-runs are safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timegrid import instant
from ..grid import Grid
from ..operators import validate
from ..operators.clean import latest_per
from ..sources import landed
from ..sources.incremental import (
    REFRESH_HOURS,
    high_water_mark,
    refresh_window,
    since_with_overlap,
)
from ..store import Store

POLICIES = ("fail", "quarantine")


def accepted(
    pages: DataFrame, rules: validate.Rules, policy: str
) -> tuple[DataFrame, DataFrame | None]:
    """Pages that keep their contract, and the refused ones with ``_reason``.

    ``fail`` raises once with the number of pages per broken rule; an unknown policy raises.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}: one of {POLICIES}")
    if policy == "fail":
        return validate.validate(pages, rules), None
    return validate.quarantine(pages, rules)


def record_pages(bodies: DataFrame, column: str, policy: str) -> tuple[DataFrame, DataFrame | None]:
    """Record pages from raw text, malformed text counted as a broken rule."""
    pages = landed.parse_record_pages(bodies, column, keep_malformed=True)
    return accepted(pages, validate.well_formed() | validate.record_page_rules(), policy)


def hourly_pages(bodies: DataFrame, column: str, policy: str) -> tuple[DataFrame, DataFrame | None]:
    """Hourly-array pages from raw text, malformed text counted as a broken rule."""
    pages = landed.parse_hourly_pages(bodies, column, keep_malformed=True)
    return accepted(pages, validate.well_formed() | validate.hourly_page_rules(), policy)


def start_of(store: Store, table: str, grid: Grid, as_of: str) -> str:
    """Where the next incremental read of a table starts.

    The mark is the newest slot of the newest day; no other day is opened.
    """
    newest = store.last_day(table)
    mark = high_water_mark(store.read(table, newest, newest), grid.time)
    return since_with_overlap(mark, as_of).first()["since"].isoformat(timespec="microseconds")


def load(store: Store, table: str, rows: DataFrame, grid: Grid) -> None:
    """Upsert the newest row per key; of equal stamps the greatest values."""
    keys = store.layout(table).upsert_keys
    others = [c for c in rows.columns if c not in {*keys, grid.ingested}]
    store.upsert(table, latest_per(rows, keys, [grid.ingested, *others]), newest_by=grid.ingested)


def run_ingest(
    store: Store,
    grid: Grid,
    records: DataFrame | None,
    readings: DataFrame | None,
    as_of: str,
    policy: str = "fail",
    column: str = "body",
) -> dict[str, DataFrame | None]:
    """One recurring run: pages later than each table's mark minus the overlap.

    ``records`` and ``readings`` hold one raw page per row in ``column``.  Gives the refused
    pages per table.
    """
    refused = {}
    stamp = instant(as_of)
    if records is not None:
        good, refused["consumption"] = record_pages(records, column, policy)
        since = start_of(store, "consumption", grid, as_of)
        rows = landed.normalise_records(landed.explode_records(good), grid, stamp, since)
        load(store, "consumption", rows, grid)
    if readings is not None:
        good, refused["weather"] = hourly_pages(readings, column, policy)
        since = start_of(store, "weather", grid, as_of)
        load(store, "weather", landed.explode_hourly(good, grid, stamp, since), grid)
    return refused


def run_reingest(
    store: Store, grid: Grid, feed: DataFrame, as_of: str, hours: int = REFRESH_HOURS
) -> None:
    """Late corrections: the last ``hours`` of a feed are read and upserted again."""
    window = refresh_window(feed, grid, as_of, hours)
    load(store, "consumption", window.filter(F.col(grid.value).isNotNull()), grid)


def run_backfill(
    store: Store,
    grid: Grid,
    archive: DataFrame,
    start: str,
    end: str,
    keys: DataFrame | None = None,
) -> None:
    """``[start, end)`` of an archive; all its periods are one job, split by Spark."""
    load(store, "consumption", landed.read_backfill(archive, grid, start, end, keys), grid)
