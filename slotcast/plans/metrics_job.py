"""Predictions and actuals in the store to the day's metrics snapshot."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import local_time
from ..functions.timegrid import instant
from ..grid import Grid
from ..operators.quality import (
    EVAL_DAYS,
    PUBLICATION_LAG_HOURS,
    TOTAL_LABEL,
    mae_alert,
    match_actuals,
    metrics_snapshot,
)
from ..store import Store


def run_metrics(
    store: Store,
    grid: Grid,
    as_of: str,
    n_keys: int,
    days: int = EVAL_DAYS,
    lag_hours: int = PUBLICATION_LAG_HOURS,
    label: str = TOTAL_LABEL,
    tz: str = "UTC",
) -> None:
    """Evaluate the last ``days`` and upsert one row per key and one for the total.

    ``tz`` is the zone whose calendar date stamps the snapshot.
    """
    now = datetime.fromisoformat(as_of)
    first_day = (now - timedelta(days=days)).date().isoformat()
    last_day = now.date().isoformat()
    matched = match_actuals(
        store.read("predictions", first_day, last_day),
        store.read("consumption", first_day, last_day),
        grid,
        as_of,
        days,
        lag_hours,
    )
    today = F.to_date(local_time(instant(as_of), tz))
    store.upsert(
        "metrics", metrics_snapshot(matched, grid, n_keys, today, instant(as_of), label)
    )


def alerts(store: Store, grid: Grid, threshold: float, label: str = TOTAL_LABEL) -> DataFrame:
    return mae_alert(store.read("metrics"), grid.key, threshold, label)
