"""Gap-safe lags, leak-safe rolling means and the hourly exogenous join.

All frames are keyed by (series, time block) instead of by series alone: rows near a
block's end are copied into the next block as history, each block is computed on its
own, and the copies are dropped.  On a grid with unique (slot, key) a group then holds
at most (block + reach) / step rows, however long a series is and however many of all
rows it owns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric
from ..functions.timegrid import hour_of, seconds, shift
from ..grid import DAY, HOUR, Grid
from ..schemas import WEATHER_MEASURES

# Hours of the lags and of the rolling window.
LAGS = (24, 48, 168)
ROLLING_HOURS = 168

# Days per frame; longer blocks copy fewer rows, shorter ones spread a series wider.
BLOCK_DAYS = 28


def block_of(secs: Column, block: int) -> Column:
    return F.floor(secs / F.lit(block)).cast("long")


def history_blocks(df: DataFrame, time: str, reach: int, block: int) -> DataFrame:
    """Copy each row into its block and, if later rows can see it, into the next one."""
    if block < reach:
        raise ValueError(f"block of {block} s is shorter than the reach of {reach} s")
    own = block_of(F.col("_secs"), block)
    seen_later = F.col("_secs") >= (own + 1) * block - reach
    blocks = F.when(seen_later, F.array(own, own + 1)).otherwise(F.array(own))
    return (
        df.withColumn("_secs", seconds(time))
        .withColumn("_block", F.explode(blocks))
        .withColumn("_history", block_of(F.col("_secs"), block) != F.col("_block"))
    )


def lag_at(value: str, frame_base, hours: int) -> Column:
    """Value exactly ``hours`` before the row; NULL where that slot is missing."""
    back = -hours * HOUR
    return F.max(value).over(frame_base.rangeBetween(back, back))


def rolling_at(value: str, frame_base, hours: int, gap: int, scale: int | None) -> Column:
    """Mean over [t - hours, t - gap], NULLs skipped, NULL on an empty window.

    Fixed-point values: the difference of two frames that only grow, on integers, so the
    cost per row does not depend on the window length.  Free values: a sliding frame, which
    adds every row it covers again, because a difference of growing sums of doubles would
    keep the rounding of values that have long left the window.
    """
    if scale is None:
        return F.avg(value).over(frame_base.rangeBetween(-hours * HOUR, -gap))
    start = Window.unboundedPreceding
    upper = frame_base.rangeBetween(start, -gap)
    below = frame_base.rangeBetween(start, -(hours * HOUR + 1))
    digits = scale + numeric.GUARD
    units = numeric.scaled(value, digits)
    zero = F.lit(0).cast("long")
    added = F.coalesce(F.sum(units).over(upper), zero) - F.coalesce(F.sum(units).over(below), zero)
    count = F.count(value).over(upper) - F.count(value).over(below)
    return added / F.lit(float(10**digits)) / F.nullif(count, F.lit(0))


def history_features(
    df: DataFrame,
    grid: Grid,
    lags: Sequence[int] = LAGS,
    rolling: int | None = ROLLING_HOURS,
    gap: int | None = None,
    block_days: int = BLOCK_DAYS,
    keep_block: bool = False,
) -> DataFrame:
    """All lags and the rolling mean in one shuffle.  Needs unique (slot, key).

    NaN and infinity count as missing values.

    ``gap`` is how long before the row the rolling window ends; one grid step keeps
    the current value out of its own feature.
    """
    gap = grid.step if gap is None else gap
    reach = max([*lags, rolling or 0]) * HOUR
    base = Window.partitionBy(grid.key, "_block").orderBy("_secs")
    added = {grid.lag_name(h): lag_at(grid.value, base, h) for h in lags}
    if rolling:
        added[grid.rolling_name(rolling)] = rolling_at(
            grid.value, base, rolling, gap, grid.scale
        )
    out = (
        history_blocks(
            df.withColumn(grid.value, numeric.finite(grid.value)), grid.time, reach, block_days * DAY
        )
        .withColumns(added)
        .filter(~F.col("_history"))
        .drop("_secs", "_history")
    )
    return out if keep_block else out.drop("_block")


def pit_lag(df: DataFrame, grid: Grid, hours: Sequence[int] = LAGS) -> DataFrame:
    """Point-in-time lags: the value exactly H hours earlier, never a row offset."""
    return history_features(df, grid, lags=hours, rolling=None)


def pit_lag_join(df: DataFrame, grid: Grid, hours: Sequence[int] = LAGS) -> DataFrame:
    """The same lags as equi self-joins on (key, slot); hashes on time as well."""
    out = df
    for h in hours:
        earlier = df.select(
            F.col(grid.key),
            shift(grid.time, h * HOUR).alias(grid.time),
            F.col(grid.value).alias(grid.lag_name(h)),
        )
        out = out.join(earlier, grid.keys, "left")
    return out


def rolling_mean(
    df: DataFrame, grid: Grid, back: int = ROLLING_HOURS, gap: int | None = None,
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """Mean of the ``back`` hours before each row, excluding the last ``gap`` seconds."""
    return history_features(
        df, grid, lags=(), rolling=back, gap=gap, block_days=block_days
    )


def hourly_mean(
    df: DataFrame, grid: Grid, measures: Sequence[str] = WEATHER_MEASURES
) -> DataFrame:
    """Exogenous readings averaged to (hour, key); partial aggregation before the shuffle."""
    return df.groupBy(hour_of(grid.time).alias("hour_dt"), F.col(grid.key)).agg(
        *[F.avg(m).alias(m) for m in measures]
    )


def join_hourly(
    df: DataFrame,
    hourly: DataFrame,
    grid: Grid,
    at: Column | str | None = None,
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """Left join of each slot to the hour that contains it, truncated in UTC.

    A frame that still carries ``_block`` is already partitioned by (key, block); the
    block is a function of the hour, so joining on it too moves only the hourly side.
    """
    slot = at if at is not None else grid.time
    left = df.withColumn("hour_dt", hour_of(slot))
    on = [grid.key, "hour_dt"]
    if "_block" in df.columns:
        hourly = hourly.withColumn(
            "_block", block_of(seconds("hour_dt"), block_days * DAY)
        )
        on = [grid.key, "_block", "hour_dt"]
    return left.join(hourly, on, "left").drop("hour_dt")
