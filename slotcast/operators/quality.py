"""Forecast quality: predictions matched with actuals, per key and over complete slots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numeric
from ..functions.timegrid import instant, shift
from ..grid import DAY, HOUR, Grid
from .clean import latest_per

# Evaluation window, publication lag, alert line, label of the total.
EVAL_DAYS = 7
PUBLICATION_LAG_HOURS = 2
MAE_ALERT = 400.0
TOTAL_LABEL = "France"


def match_all(
    predictions: DataFrame, raw: DataFrame, grid: Grid, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Predictions with the deduplicated actual of the same key and slot."""
    order = [grid.ingested, *(tiebreak or [grid.value])]
    actual = raw.withColumnRenamed(grid.time, "forecast_horizon_dt")
    actual = latest_per(actual, ["forecast_horizon_dt", grid.key], order)
    actual = actual.filter(F.col(grid.value).isNotNull())
    return predictions.select("forecast_horizon_dt", grid.key, "predicted_mw").join(
        actual.select("forecast_horizon_dt", grid.key, grid.value),
        ["forecast_horizon_dt", grid.key],
        "inner",
    )


def match_actuals(
    predictions: DataFrame,
    raw: DataFrame,
    grid: Grid,
    as_of: str,
    days: int = EVAL_DAYS,
    lag_hours: int = PUBLICATION_LAG_HOURS,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Pairs with slots in [as_of - days, as_of - lag]; both inputs are bounded first."""
    low = shift(instant(as_of), -days * DAY)
    high = shift(instant(as_of), -lag_hours * HOUR)
    return match_all(
        predictions.filter(F.col("forecast_horizon_dt").between(low, high)),
        raw.filter(F.col(grid.time).between(low, high)),
        grid,
        tiebreak,
    )


def error_columns(error: Column, scale: int | None) -> list[Column]:
    """MAE, exact interpolated percentiles and count of absolute errors.

    A group holds one value per slot of the evaluation window, so the exact percentile
    buffer is bounded by days * slots per day, not by the size of the table.
    """
    tails = F.percentile(error, F.array(F.lit(0.95), F.lit(0.99)))
    return [
        numeric.free_mean(error, scale).alias("mae_mw"),
        tails[0].alias("p95_error_mw"),
        tails[1].alias("p99_error_mw"),
        F.count("*").alias("n_samples"),
    ]


def key_metrics(matched: DataFrame, grid: Grid, by: Sequence[str] = ()) -> DataFrame:
    """Error metrics per key (and per ``by``, for several snapshots at once)."""
    error = F.abs(F.col("predicted_mw") - F.col(grid.value))
    return matched.groupBy(*by, grid.key).agg(*error_columns(error, grid.scale))


def national_metrics(
    matched: DataFrame,
    grid: Grid,
    n_keys: int,
    label: str = TOTAL_LABEL,
    by: Sequence[str] = (),
) -> DataFrame:
    """Metrics of the sum over keys, on slots where all keys are present.

    Completeness is a condition on the slot aggregate itself, so no join back.
    """
    slots = (
        matched.groupBy(*by, "forecast_horizon_dt")
        .agg(
            F.count_distinct(grid.key).alias("_n"),
            numeric.free_total("predicted_mw", grid.scale).alias("predicted_mw"),
            numeric.total(grid.value, grid.scale).alias(grid.value),
        )
        .filter(F.col("_n") == n_keys)
    )
    error = F.abs(F.col("predicted_mw") - F.col(grid.value))
    out = slots.groupBy(*by).agg(*error_columns(error, grid.scale)).filter("n_samples > 0")
    return out.select(*by, F.lit(label).alias(grid.key), *out.columns[len(by):])


def metrics_snapshot(
    matched: DataFrame,
    grid: Grid,
    n_keys: int,
    computed_date: Column,
    computed_at: Column,
    label: str = TOTAL_LABEL,
) -> DataFrame:
    """Per-key and national metrics of one evaluation, stamped, non-finite rows dropped."""
    rows = key_metrics(matched, grid).unionByName(national_metrics(matched, grid, n_keys, label))
    finite = [numeric.is_finite(c) for c in ("mae_mw", "p95_error_mw", "p99_error_mw")]
    return rows.filter(finite[0] & finite[1] & finite[2]).select(
        computed_date.cast("date").alias("computed_date"),
        grid.key,
        "mae_mw",
        "p95_error_mw",
        "p99_error_mw",
        "n_samples",
        computed_at.cast("timestamp").alias("_computed_at"),
    )


def metrics_backfill(
    matched: DataFrame,
    grid: Grid,
    n_keys: int,
    first_day: str,
    last_day: str,
    days: int = EVAL_DAYS,
    lag_hours: int = PUBLICATION_LAG_HOURS,
    label: str = TOTAL_LABEL,
) -> DataFrame:
    """Snapshots as of 00:00 UTC of every day of a range, in one plan.

    Each pair is copied to the at most ``days`` evaluation days whose window holds it.
    """
    slot = F.col("forecast_horizon_dt")
    day = F.expr("INTERVAL 1 DAY")
    first = F.greatest(
        F.date_trunc("day", shift(slot, lag_hours * HOUR + DAY) - F.expr("INTERVAL 1 MICROSECOND")),
        instant(first_day),
    )
    last = F.least(F.date_trunc("day", shift(slot, days * DAY)), instant(last_day))
    spread = matched.filter(first <= last).withColumn(
        "computed_at", F.explode(F.sequence(first, last, day))
    )
    by = ["computed_at"]
    rows = key_metrics(spread, grid, by).unionByName(
        national_metrics(spread, grid, n_keys, label, by)
    )
    finite = [numeric.is_finite(c) for c in ("mae_mw", "p95_error_mw", "p99_error_mw")]
    return rows.filter(finite[0] & finite[1] & finite[2]).select(
        F.to_date("computed_at").alias("computed_date"),
        grid.key,
        "mae_mw",
        "p95_error_mw",
        "p99_error_mw",
        "n_samples",
        F.col("computed_at").alias("_computed_at"),
    )


def mae_alert(
    metrics: DataFrame, key: str, threshold: float = MAE_ALERT, label: str = TOTAL_LABEL
) -> DataFrame:
    """National rows above the alert line."""
    return metrics.filter((F.col(key) == label) & (F.col("mae_mw") > threshold))
