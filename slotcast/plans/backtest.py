"""Walk-forward evaluation: every day is trained and forecast with what was known then."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric
from ..functions.timegrid import from_seconds, seconds
from ..grid import DAY, HOUR, Grid
from ..operators.clean import latest_per
from ..operators.features import BLOCK_DAYS, block_of
from ..operators.horizon import ANCHOR_HOUR, anchor_of
from ..operators.training import HORIZON_HOURS, LOOKBACK_DAYS, MIN_ROWS, VAL_FRACTION
from ..session import stage
from ..sources.periods import days_between
from .forecast_job import forecast_frame, naive_forecast, stamp_predictions

# Fixed value: local hour at which each day's training stops reading.
TRAIN_HOUR = 2


def fold_days(keys: DataFrame, first_day: str, last_day: str, tz: str) -> DataFrame:
    """One row per forecast day with its training cutoff, in seconds."""
    days = days_between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    return (
        keys.sparkSession.range(1)
        .select(F.explode(days).alias("forecast_date"))
        .withColumn("cutoff", seconds(anchor_of(F.col("forecast_date"), tz, TRAIN_HOUR)))
    )


def totals_until(
    slots: DataFrame, points: DataFrame, time: str, measures: Sequence[str], block: int
) -> DataFrame:
    """For each point in time: totals of ``measures`` over the slots up to and including it.

    Also the last slot up to the point (``last_slot``) and the first one from it on
    (``next_slot``).  A two-level running sum: within time blocks by window, across
    blocks on one row per block, so no frame spans the whole history.
    """
    own = slots.select(F.col(time).alias("_at"), F.col(time).alias("_slot"), *measures)
    asked = points.select(F.col("at").alias("_at"), F.struct(*points.columns).alias("_point"))
    both = own.unionByName(asked, allowMissingColumns=True).withColumn(
        "_block", block_of(F.col("_at"), block)
    )
    per_block = both.groupBy("_block").agg(
        *[F.sum(m).alias(f"_{m}") for m in measures],
        F.max("_slot").alias("_last"),
        F.min("_slot").alias("_first"),
    )
    across = Window.orderBy("_block")  # one row per block of several weeks
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    after = across.rowsBetween(1, Window.unboundedFollowing)
    carried = per_block.select(
        "_block",
        *[F.coalesce(F.sum(f"_{m}").over(before), F.lit(0)).alias(f"_{m}") for m in measures],
        F.max("_last").over(before).alias("_last"),
        F.min("_first").over(after).alias("_first"),
    )
    inside = Window.partitionBy("_block").orderBy("_at")
    up_to = inside.rangeBetween(Window.unboundedPreceding, 0)
    onward = inside.rangeBetween(0, Window.unboundedFollowing)
    return (
        both.withColumns(
            {
                **{f"_run_{m}": F.sum(m).over(up_to) for m in measures},
                "_run_last": F.max("_slot").over(up_to),
                "_run_next": F.min("_slot").over(onward),
            }
        )
        .filter(F.col("_point").isNotNull())
        .join(carried, "_block")
        .select(
            "_point.*",
            *[
                (F.coalesce(f"_run_{m}", F.lit(0)) + F.col(f"_{m}")).alias(m)
                for m in measures
            ],
            F.coalesce("_run_last", "_last").alias("last_slot"),
            F.coalesce("_run_next", "_first").alias("next_slot"),
        )
    )


def fold_summary(
    frame: DataFrame,
    grid: Grid,
    first_day: str,
    last_day: str,
    predicted: str,
    lookback_days: int = LOOKBACK_DAYS,
    horizon_hours: int = HORIZON_HOURS,
    val_fraction: float = VAL_FRACTION,
    min_rows: int = MIN_ROWS,
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """Training rows, time split and validation MAE of a baseline for every day at once.

    A row belongs to the frames of up to ``lookback_days`` days.  Instead of copying it
    to each, rows are aggregated per slot and every fold reads differences of running
    totals at its three bounds.
    """
    scale = grid.scale
    error = F.abs(F.col(predicted) - F.col(grid.value))
    units = error if scale is None else numeric.scaled(error, scale)
    zero = F.lit(0.0) if scale is None else F.lit(0).cast("long")
    # One row a slot, written once: both look-ups and the days of the folds read it.
    slots = stage(
        frame.groupBy(seconds(grid.time).alias("slot")).agg(
            F.count("*").alias("n"),
            F.count(error).alias("n_err"),
            F.coalesce(F.sum(units), zero).alias("err"),
        )
    )
    measures = ["n", "n_err", "err"]
    block = block_days * DAY
    folds = fold_days(frame, first_day, last_day, grid.tz).withColumns(
        {
            "low": F.col("cutoff") - lookback_days * DAY,
            "high": F.col("cutoff") - horizon_hours * HOUR - 1,
        }
    )
    bounds = F.explode(
        F.array(
            F.struct(F.lit("low").alias("bound"), (F.col("low") - 1).alias("at")),
            F.struct(F.lit("from").alias("bound"), F.col("low").alias("at")),
            F.struct(F.lit("high").alias("bound"), F.col("high").alias("at")),
        )
    )
    points = folds.select("forecast_date", bounds.alias("b")).select("forecast_date", "b.*")
    at = totals_until(slots, points, "slot", measures, block)

    def pick(df: DataFrame, bounds_: dict[str, tuple[str, str]], keep: Sequence[str]) -> DataFrame:
        """Bounds of a fold side by side, by conditional aggregation."""
        return df.groupBy("forecast_date", *keep).agg(
            *[
                F.max(F.when(F.col("bound") == bound, F.col(column))).alias(name)
                for name, (bound, column) in bounds_.items()
            ]
        )

    ends = pick(
        at,
        {
            "n_low": ("low", "n"),
            "n_high": ("high", "n"),
            "t_min": ("from", "next_slot"),
            "t_max": ("high", "last_slot"),
            "n_err_high": ("high", "n_err"),
            "err_high": ("high", "err"),
        },
        [],
    ).filter(F.col("n_high") > F.col("n_low"))
    cut = F.col("t_min") + F.floor((F.col("t_max") - F.col("t_min")) * F.lit(1 - val_fraction))
    split = ends.withColumn("at", cut.cast("long"))
    out = totals_until(slots, split, "slot", measures, block)
    n_val_err = F.col("n_err_high") - F.col("n_err")
    added = F.col("err_high") - F.col("err")
    if scale is not None:
        added = added / F.lit(float(10**scale))
    return out.select(
        "forecast_date",
        from_seconds(F.col("t_min")).alias("t_min"),
        from_seconds(F.col("t_max")).alias("t_max"),
        (F.col("n_high") - F.col("n_low")).alias("n_rows"),
        (F.col("n") - F.col("n_low")).alias("n_train"),
        (F.col("n_high") - F.col("n")).alias("n_val"),
        (added / F.nullif(n_val_err, F.lit(0))).alias("val_mae"),
        (F.col("n_high") - F.col("n_low") >= min_rows).alias("fit"),
    )


def walk_forward_naive(
    history: DataFrame,
    hourly: DataFrame,
    keys: DataFrame,
    grid: Grid,
    first_day: str,
    last_day: str,
    folds: DataFrame | None = None,
    lag_column: str | None = None,
    exog_at: str = "target_time",
    as_known: bool = False,
) -> DataFrame:
    """Baseline predictions of every day of a range in one plan.

    With ``as_known``, ``history`` is the raw records and each day uses only what had
    arrived by its anchor; otherwise final values are used up to the anchor.
    Days that fail the training gate of ``folds`` are left out.  Where two days predict
    the same slot (the spring clock change) the later day wins, as upserts in day order
    would leave it.
    """
    frame = forecast_frame(
        history, hourly, keys, first_day, last_day, grid, exog_at, as_known=as_known
    )
    if folds is not None:
        frame = frame.join(folds.filter("fit").select("forecast_date"), "forecast_date", "left_semi")
    scored = naive_forecast(frame, lag_column or grid.lag_name(24))
    rows = stamp_predictions(
        scored.filter(F.col("predicted_mw").isNotNull()),
        grid,
        F.lit("naive24"),
        F.col("forecast_date"),
        F.col("anchor"),
    )
    return latest_per(rows, ["forecast_horizon_dt", grid.key], ["forecast_date"])


__all__ = [
    "TRAIN_HOUR",
    "fold_days",
    "fold_summary",
    "totals_until",
    "walk_forward_naive",
]
