"""History and readings to prediction rows for one or many forecast days."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import calendar
from ..functions.timegrid import shift
from ..grid import HOUR, Grid
from ..operators.clean import dedupe_latest, latest_per
from ..operators.features import hourly_mean, join_hourly
from ..operators.horizon import (
    ANCHOR_HOUR,
    HISTORY_HOURS,
    SHIFT_HOURS,
    aligned_history,
    anchor_of,
    lag_fallback,
    scaffold,
)
from ..operators.validate import prediction_rules, validate
from ..session import staged
from ..sources.periods import days_between
from ..store import Store


def known_history(
    history: DataFrame,
    first_day: str,
    last_day: str,
    grid: Grid,
    anchor_hour: int = ANCHOR_HOUR,
    lookback_hours: int = HISTORY_HOURS,
    publication_lag_hours: int = 0,
) -> DataFrame:
    """History that the forecasts of these days may use: a bounded look-back, before the anchor.

    Every frame ends at slot - 24 h - step, which lies before the day's own anchor, so
    the same rows serve all days of a range.  A ``publication_lag_hours`` holds values
    back per day and is only meaningful for one day at a time.
    """
    if publication_lag_hours and first_day != last_day:
        raise ValueError("a publication lag applies to one forecast day at a time")
    first = anchor_of(F.lit(first_day).cast("date"), grid.tz, anchor_hour)
    last = anchor_of(F.lit(last_day).cast("date"), grid.tz, anchor_hour)
    return history.filter(
        (F.col(grid.time) >= shift(first, -lookback_hours * HOUR))
        & (F.col(grid.time) < shift(last, -publication_lag_hours * HOUR))
        & F.col(grid.value).isNotNull()
    )


def history_as_known(
    raw: DataFrame,
    first_day: str,
    last_day: str,
    grid: Grid,
    anchor_hour: int = ANCHOR_HOUR,
    lookback_hours: int = HISTORY_HOURS,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """For each forecast day, the series as it stood at that day's anchor.

    A record counts for the days whose look-back holds its slot (at most
    ``lookback_hours / 24 + 1``) if it had arrived by then, so later corrections and late
    publishers do not leak into a backtest.  Each version of a slot is valid from its arrival
    until the next one's, so only the days of its own interval get a copy.  Of the versions that
    arrive between two anchors only the last is seen; the others go before the shuffle.
    """
    order = [grid.ingested, *(tiebreak or [grid.value])]
    first, last = F.lit(first_day).cast("date"), F.lit(last_day).cast("date")
    arrived, at = F.col(grid.ingested), F.col(grid.time)
    ends = anchor_of(last, grid.tz, anchor_hour)
    near = raw.filter(
        F.col(grid.value).isNotNull()
        & (arrived <= ends)
        & (at < ends)
        & (at >= shift(anchor_of(first, grid.tz, anchor_hour), -lookback_hours * HOUR))
    )
    # The day whose anchor is the first to see a record.
    day = F.to_date(arrived)
    seen_by = (
        F.when(arrived > anchor_of(day, grid.tz, anchor_hour), F.date_add(day, 1))
        .when(arrived <= anchor_of(F.date_sub(day, 1), grid.tz, anchor_hour), F.date_sub(day, 1))
        .otherwise(day)
    )
    seen = latest_per(near.withColumn("_seen_by", seen_by), [*grid.keys, "_seen_by"], order)
    versions = Window.partitionBy(*grid.keys).orderBy("_seen_by")
    known = seen.withColumn("_until", F.lead(grid.ingested).over(versions)).drop("_seen_by")
    # A day's anchor lies within a day of its midnight, whatever the zone.
    low = F.greatest(F.date_sub(F.to_date(grid.time), 1), first, F.date_sub(F.to_date(grid.ingested), 1))
    high = F.least(
        F.date_add(F.to_date(grid.time), lookback_hours // 24 + 2), last, F.date_add(F.to_date("_until"), 1)
    )
    anchor = anchor_of(F.col("forecast_date"), grid.tz, anchor_hour)
    return (
        known.filter(low <= high)
        .withColumn("forecast_date", F.explode(days_between(low, high)))
        .filter(
            (F.col(grid.time) >= shift(anchor, -lookback_hours * HOUR))
            & (F.col(grid.time) < anchor)
            & (F.col(grid.ingested) <= anchor)
            & (F.col("_until").isNull() | (F.col("_until") > anchor))
        )
        .drop("_until")
    )


def forecast_frame(
    history: DataFrame,
    hourly: DataFrame,
    keys: DataFrame,
    first_day: str,
    last_day: str,
    grid: Grid,
    exog_at: str = "target_time",
    anchor_hour: int = ANCHOR_HOUR,
    steps: int | None = None,
    publication_lag_hours: int = 0,
    as_known: bool = False,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Model inputs for every (day, slot, key).

    ``history`` has unique (slot, key); with ``as_known`` it is the raw records and each
    day sees only what had arrived by its anchor.  ``exog_at`` says where weather and calendar
    are read: at the slot ('target_time', also 'reference') or at T = slot - 24 h
    ('feature_time'); training must use the same setting.
    """
    slots = scaffold(keys, first_day, last_day, grid, anchor_hour, steps)
    if as_known:
        known = history_as_known(
            history, first_day, last_day, grid, anchor_hour, tiebreak=tiebreak
        )
        aligned = aligned_history(slots, known, grid, by=("forecast_date",))
    else:
        known = known_history(
            history, first_day, last_day, grid, anchor_hour,
            publication_lag_hours=publication_lag_hours,
        )
        aligned = aligned_history(slots, known, grid)
    rows = lag_fallback(aligned, grid)
    back = SHIFT_HOURS * HOUR if exog_at == "feature_time" else 0
    rows = rows.withColumn("_exog_at", shift("forecast_horizon_dt", -back))
    rows = join_hourly(rows, hourly, grid, at="_exog_at")
    return calendar(rows, "_exog_at", grid.tz).drop("_exog_at")


def naive_forecast(frame: DataFrame, lag_column: str) -> DataFrame:
    """Baseline: the prediction is a lag column."""
    return frame.withColumn("predicted_mw", F.col(lag_column))


def stamp_predictions(
    frame: DataFrame,
    grid: Grid,
    model_version: Column,
    forecast_date: Column,
    forecasted_at: Column,
) -> DataFrame:
    """Prediction rows in the declared column order."""
    return frame.select(
        "forecast_horizon_dt",
        grid.key,
        "predicted_mw",
        model_version.cast("string").alias("model_version"),
        forecast_date.cast("date").alias("forecast_date"),
        forecasted_at.cast("timestamp").alias("forecasted_at"),
    )


def run_forecast(
    store: Store,
    grid: Grid,
    day: str,
    labels: Sequence[str],
    score_with: Callable[[DataFrame], DataFrame],
    model_version: str,
    forecasted_at: str,
    exog_at: str = "target_time",
    steps: int | None = None,
) -> None:
    """Forecast one day from the store and upsert the predictions.

    ``score_with`` appends ``predicted_mw``.  The batch is all or nothing: one unknown
    region or one value that is not positive and finite refuses it.
    """
    first = date.fromisoformat(day)
    history_day = (first - timedelta(days=HISTORY_HOURS // 24 + 1)).isoformat()
    next_day = (first + timedelta(days=1)).isoformat()
    keys = store.spark.createDataFrame([(label,) for label in labels], f"{grid.key} string")
    frame = forecast_frame(
        dedupe_latest(store.read("consumption", history_day, day), grid, drop_null_value=True),
        hourly_mean(store.read("weather", (first - timedelta(days=1)).isoformat(), next_day), grid),
        keys,
        day,
        day,
        grid,
        exog_at,
        steps=steps,
    )
    # Scored once: the check and the write both read the stored rows.
    scored = stamp_predictions(
        score_with(frame), grid, F.lit(model_version), F.lit(day), F.lit(forecasted_at)
    )
    with staged(scored) as rows:
        store.upsert("predictions", validate(rows, prediction_rules(grid.key, labels)))
