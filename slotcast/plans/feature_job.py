"""Raw series and readings to feature rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..files import exists
from ..functions.calendar import calendar
from ..functions.timegrid import instant, shift
from ..grid import HOUR, Grid
from ..operators.clean import dedupe_latest
from ..operators.features import (
    LAGS,
    ROLLING_HOURS,
    history_features,
    hourly_mean,
    join_hourly,
)
from ..sources.incremental import DEFAULT_LOOKBACK_DAYS
from ..store import Store

SEEN = "table_name string, day string, files string"


def build_features(
    raw: DataFrame,
    weather: DataFrame,
    grid: Grid,
    since: str | None = None,
    until: str | None = None,
    tiebreak: Sequence[str] = (),
    lags: Sequence[int] = LAGS,
    rolling: int = ROLLING_HOURS,
    deduplicate: bool = True,
) -> DataFrame:
    """Feature rows with ``since < t <= until``.

    The input is bounded by hand to ``since`` minus the longest look-back, because a
    filter on the ordering column must not move below a window; those history rows
    feed the lags and are not emitted.  ``deduplicate=False`` saves one shuffle of the
    raw rows where a keyed upsert is their only writer.
    """
    reach = max([*lags, rolling]) * HOUR
    if since is not None:
        low = shift(instant(since), -reach)
        raw = raw.filter(F.col(grid.time) >= low)
        weather = weather.filter(F.col(grid.time) >= low)
    if until is not None:
        raw = raw.filter(F.col(grid.time) <= instant(until))
        weather = weather.filter(F.col(grid.time) < shift(instant(until), HOUR))
    if deduplicate:
        raw = dedupe_latest(raw, grid, tiebreak)
    slots = raw.select(*grid.keys, grid.value)
    rows = history_features(slots, grid, lags, rolling, keep_block=True)
    if since is not None:
        rows = rows.filter(F.col(grid.time) > instant(since))
    rows = join_hourly(rows, hourly_mean(weather, grid), grid).drop("_block", grid.value)
    return calendar(rows, grid.time, grid.tz)


def _text(moment) -> str:
    return moment.isoformat(timespec="microseconds")


def _day(moment) -> str:
    return moment.date().isoformat()


RAW = ("consumption", "weather")


def listing(store: Store) -> dict[tuple[str, str], str]:
    """(table, day): digest of the day's file names, for the raw tables.

    One entry per table and calendar day; no file is opened.
    """
    return {(name, row["day"]): row["files"] for name in RAW for row in store.day_files(name).collect()}


def _seen_path(store: Store) -> str:
    return f"{store.root}/_seen/features"


def seen(store: Store) -> dict[tuple[str, str], str]:
    """The listing that the stored features were computed from; empty if there is none."""
    if not exists(store.spark, _seen_path(store)):
        return {}
    rows = store.spark.read.schema(SEEN).parquet(_seen_path(store)).collect()
    return {(r["table_name"], r["day"]): r["files"] for r in rows}


def remember(store: Store, entries: dict[tuple[str, str], str]) -> None:
    rows = [(*where, files) for where, files in sorted(entries.items())]
    frame = store.spark.createDataFrame(rows, SEEN).coalesce(1)
    frame.write.mode("overwrite").parquet(_seen_path(store))


def days_from(days: Iterable[str], before: int, after: int) -> list[str]:
    """The given days, each widened by days before and after it."""
    wide = {
        (date.fromisoformat(day) + timedelta(days=k)).isoformat()
        for day in days
        for k in range(-before, after + 1)
    }
    return sorted(wide)


def materialize_incremental(
    store: Store,
    grid: Grid,
    as_of: str,
    since: str | None = None,
    mode: str = "changed",
    deduplicate: bool = True,
) -> None:
    """Compute and upsert the feature rows that new data can have changed.

    * ``since`` given: every row after it.
    * ``mode='changed'``: days of raw rows whose files are not those of the run before, however
      late they were committed and whatever their stamps.  A value at u reaches the rows u to
      u + look-back, so each such day and the look-back after it is computed again, and no
      other day is opened.
    * ``mode='reference'``: only rows after the newest feature row; late keys and
      corrections are not picked up.

    An empty feature table starts 7 days before ``as_of``.  The files seen are noted after the
    rows are stored, as they were listed before the read: what is committed during a run is
    seen by the next one, and a run that stops is repeated.  Without a note every day counts as
    changed.
    """
    files = listing(store)
    options = {"deduplicate": deduplicate}
    known = seen(store) if mode == "changed" or since is not None else {}
    if since is None:
        newest = store.last_day("features")
        last_slot = store.read("features", newest, newest).agg(F.max(grid.time)).first()[0]
        if last_slot is None:
            since = _text(datetime.fromisoformat(as_of) - timedelta(days=DEFAULT_LOOKBACK_DAYS))
            known = {}
        elif mode == "reference":
            since = _text(last_slot)
    if since is not None:
        first = _day(datetime.fromisoformat(since) - timedelta(hours=ROLLING_HOURS))
        rows = build_features(
            store.read("consumption", first), store.read("weather", first), grid, since, **options
        )
        # Days before the given start stay as they were noted.
        done = {w: f for w, f in files.items() if w[1] >= since[:10] or not known}
        files = {w: f for w, f in known.items() if w[1] < since[:10] and w in files} | done
    else:
        touched = sorted({day for (name, day), f in files.items() if known.get((name, day)) != f})
        if not touched:
            return
        look_back = -(-ROLLING_HOURS // 24)
        affected = days_from(touched, 0, look_back)
        needed = days_from(affected, look_back, 0)
        rows = build_features(
            *(store.read_days(name, needed) for name in RAW), grid, **options
        ).filter(F.to_date(grid.time).isin([date.fromisoformat(d) for d in affected]))
    store.upsert("features", rows.withColumn("_materialized_at", instant(as_of)))
    remember(store, files)
