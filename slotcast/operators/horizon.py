"""The forecast horizon: slots, scaffold, and history aligned with training.

A prediction for slot S uses what training saw at T = S - 24 h.  Scaffold rows are
placed among the history at T and go through the same frames as the features, so the
lags and the rolling mean need one shuffle and no range join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import numeric
from ..functions.calendar import utc_of_local
from ..functions.timegrid import seconds, shift
from ..grid import DAY, HOUR, Grid
from ..sources.periods import days_between
from .features import (
    BLOCK_DAYS,
    LAGS,
    ROLLING_HOURS,
    block_of,
    history_blocks,
    lag_at,
    rolling_at,
)

# Distance from feature time to slot, local anchor, history read.
SHIFT_HOURS = 24
ANCHOR_HOUR = 6
HISTORY_HOURS = 216


def anchor_of(day: Column, tz: str, hour: int = ANCHOR_HOUR) -> Column:
    """UTC instant of a local hour on a local date."""
    wall = day.cast("timestamp") + F.expr(f"INTERVAL '{hour}' HOUR")
    return utc_of_local(wall, tz)


def _slot_columns(df: DataFrame, grid: Grid, hour: int, steps: int | None) -> DataFrame:
    steps = grid.slots_per_day if steps is None else steps
    step = F.expr(f"INTERVAL '{grid.step}' SECOND")
    last = shift("anchor", (steps - 1) * grid.step)
    return df.withColumn("anchor", anchor_of(F.col("forecast_date"), grid.tz, hour)).withColumn(
        "forecast_horizon_dt", F.explode(F.sequence(F.col("anchor"), last, step))
    )


def day_range(spark: SparkSession, first_day: str, last_day: str) -> DataFrame:
    """Forecast days from one date to another, inclusive."""
    days = days_between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    return spark.range(1).select(F.explode(days).alias("forecast_date"))


def horizon_slots(
    days: DataFrame, grid: Grid, anchor_hour: int = ANCHOR_HOUR, steps: int | None = None
) -> DataFrame:
    """Slots of each ``forecast_date``, anchored at a local hour, in absolute steps.

    Always ``steps`` slots, also on the days the clock changes, and the same on a re-run.
    """
    return _slot_columns(days.select("forecast_date"), grid, anchor_hour, steps)


def scaffold(
    keys: DataFrame,
    first_day: str,
    last_day: str,
    grid: Grid,
    anchor_hour: int = ANCHOR_HOUR,
    steps: int | None = None,
) -> DataFrame:
    """Every slot of every day for every key, even without history.

    The slots are generated on each key row, so no join is involved.
    """
    rows = keys.select(
        grid.key,
        F.explode(
            days_between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
        ).alias("forecast_date"),
    )
    return _slot_columns(rows, grid, anchor_hour, steps)


def aligned_history(
    slots: DataFrame,
    history: DataFrame,
    grid: Grid,
    shift_hours: int = SHIFT_HOURS,
    lags: tuple[int, ...] = LAGS,
    rolling: int | None = ROLLING_HOURS,
    gap: int | None = None,
    block_days: int = BLOCK_DAYS,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Lags and rolling mean at T = slot - ``shift_hours`` for each scaffold row.

    ``history`` has unique (slot, key), or unique (slot, key, *by) where every row sees
    only the history with its own ``by`` values.  The scaffold rows carry no value, so
    they never enter a frame; they are dropped into their own block only.
    """
    gap = grid.step if gap is None else gap
    block = block_days * DAY
    reach = max([*lags, rolling or 0]) * HOUR
    group = [grid.key, *by]
    known = history.select(*group, grid.time, numeric.finite(grid.value).alias(grid.value))
    past = history_blocks(known, grid.time, reach, block)
    payload = F.struct(*[c for c in slots.columns if c not in group])
    asked = (
        slots.select(*group, payload.alias("_slot"))
        .withColumn("_secs", seconds("_slot.forecast_horizon_dt") - shift_hours * HOUR)
        .withColumn("_block", block_of(F.col("_secs"), block))
    )
    union = past.select(*group, "_block", "_secs", grid.value).unionByName(
        asked, allowMissingColumns=True
    )
    base = Window.partitionBy(*group, "_block").orderBy("_secs")
    added = {grid.lag_name(h): lag_at(grid.value, base, h) for h in lags}
    if rolling:
        added[grid.rolling_name(rolling)] = rolling_at(grid.value, base, rolling, gap, grid.scale)
    return (
        union.withColumns(added)
        .filter(F.col("_slot").isNotNull())
        .select("_slot.*", *group, *added)
    )


def aligned_lags(slots: DataFrame, history: DataFrame, grid: Grid, **options) -> DataFrame:
    return aligned_history(slots, history, grid, rolling=None, **options)


def aligned_rolling(slots: DataFrame, history: DataFrame, grid: Grid, **options) -> DataFrame:
    return aligned_history(slots, history, grid, lags=(), **options)


def lag_fallback(df: DataFrame, grid: Grid, primary: int = 24, backup: int = 48) -> DataFrame:
    """Fill a missing primary lag from the backup lag and flag the rows that used it."""
    first, second = F.col(grid.lag_name(primary)), F.col(grid.lag_name(backup))
    return df.withColumn("used_fallback", first.isNull() & second.isNotNull()).withColumn(
        grid.lag_name(primary), F.coalesce(first, second)
    )


def fallback_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.count_if("used_fallback").alias("n_fallback"))
