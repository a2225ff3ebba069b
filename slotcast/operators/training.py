"""Training frames with a shifted target, time splits, encoding and gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import calendar
from ..functions.timegrid import instant, shift
from ..grid import DAY, HOUR, Grid
from ..schemas import WEATHER_MEASURES
from .clean import latest_per, null_gate
from .features import join_hourly

# Horizon, look-back, share of the time range held out, least rows.
HORIZON_HOURS = 24
LOOKBACK_DAYS = 730
VAL_FRACTION = 0.2
MIN_ROWS = 200


def shifted_target(
    raw: DataFrame, grid: Grid, horizon_hours: int = HORIZON_HOURS, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Value at t + horizon, addressed by t; latest ingestion wins.

    The time is shifted before deduplicating, so the join that follows finds this side
    already partitioned by its own keys.
    """
    order = [grid.ingested, *(tiebreak or [grid.value])]
    moved = raw.withColumn(grid.time, shift(grid.time, -horizon_hours * HOUR))
    return latest_per(moved, grid.keys, order).select(*grid.keys, grid.value)


def training_frame(
    features: DataFrame,
    raw: DataFrame,
    grid: Grid,
    as_of: str | None = None,
    cutoff: str | None = None,
    horizon_hours: int = HORIZON_HOURS,
    lookback_days: int = LOOKBACK_DAYS,
    required: Sequence[str] | None = None,
    exog_at: str = "target_time",
    hourly: DataFrame | None = None,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Features at T with the target at T + horizon.

    ``as_of`` bounds the look-back only; ``cutoff`` also drops everything the run could
    not have known (T and the target time lie before it).  ``exog_at='target_time'``
    reads calendar and weather at the target time, as scoring does; 'feature_time' and
    'reference' keep them at T.
    """
    low = shift(instant(cutoff or as_of), -lookback_days * DAY)
    features = features.filter(F.col(grid.time) >= low)
    raw = raw.filter(F.col(grid.time) >= shift(low, horizon_hours * HOUR))
    if cutoff is not None:
        features = features.filter(F.col(grid.time) < shift(instant(cutoff), -horizon_hours * HOUR))
        raw = raw.filter(F.col(grid.time) < instant(cutoff))
    if exog_at == "target_time":
        if hourly is None:
            raise ValueError("exog_at='target_time' needs the hourly readings")
        features = features.drop(*WEATHER_MEASURES).withColumn(
            "_target_time", shift(grid.time, horizon_hours * HOUR)
        )
        features = join_hourly(features, hourly, grid, at="_target_time")
        features = calendar(features, "_target_time", grid.tz).drop("_target_time")
    target = shifted_target(raw, grid, horizon_hours, tiebreak)
    frame = features.join(target, grid.keys, "inner")
    if required is None:
        required = [grid.lag_name(24)]
    return null_gate(frame, [*required, grid.value])


def time_split(df: DataFrame, time: str, val_fraction: float = VAL_FRACTION) -> DataFrame:
    """Mark rows train or val by a cut of the time range, not of the rows.

    The range is a scalar subquery over the same frame: no join and no collected value,
    but the frame is read twice, so pass one that is stored (``session.stage``).
    """
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    low, high = F.min(micros), F.max(micros)
    cut = (low + F.floor((high - low) * F.lit(1 - val_fraction))).alias("cut")
    return df.withColumn(
        "split",
        F.when(micros <= df.agg(cut).scalar(), F.lit("train")).otherwise(F.lit("val")),
    )


def encode(df: DataFrame, labels: Sequence[str], key: str) -> DataFrame:
    """Index of the key in a fixed label list (NULL if unknown) and flags as integers.

    The list is a literal, so no dimension is joined.
    """
    flags = [f.name for f in df.schema.fields if f.dataType.typeName() == "boolean"]
    position = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(key)).cast("int")
    return df.withColumns(
        {
            f"{key}_idx": F.nullif(position, F.lit(0)) - 1,
            **{c: F.col(c).cast("int") for c in flags},
        }
    )


def min_rows_gate(df: DataFrame, by: str, min_rows: int = MIN_ROWS) -> DataFrame:
    """Rows per group and whether a fit is allowed."""
    return df.groupBy(by).agg(F.count("*").alias("n_rows")).withColumn(
        "fit", F.col("n_rows") >= min_rows
    )


def enough_rows(df: DataFrame, min_rows: int = MIN_ROWS) -> bool:
    """Does the frame reach the minimum?  Stops reading once it does."""
    return df.limit(min_rows).count() >= min_rows


def latest_run(run_log: DataFrame, run: str, created: str) -> DataFrame:
    """The run a forecast must use: the newest, ties settled by the run id."""
    newest = F.max_by(F.struct(run, created), F.struct(created, run)).alias("newest")
    return run_log.agg(newest).select("newest.*")


def stale_versions(artifacts: DataFrame, run: str, created: str, keep: int = 7) -> DataFrame:
    """Runs beyond the ``keep`` newest; a run is as old as its earliest artifact.

    The newest runs are a distributed top-k of at most ``keep`` rows, removed by an
    anti join; no global ranking of all runs.
    """
    runs = artifacts.groupBy(run).agg(F.min(created).alias("run_time"))
    newest = runs.orderBy(F.desc("run_time"), F.desc(run)).limit(keep).select(run)
    return runs.join(F.broadcast(newest), run, "left_anti")
