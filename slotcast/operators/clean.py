"""Latest-wins deduplication, time filters, complete slots, required columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timegrid import instant
from ..grid import Grid


def latest_per(
    df: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One row per ``keys``: the one that is last in ``order`` (NULLs count as earliest).

    Spark limits each group before the shuffle (``WindowGroupLimit``), so a cell with
    a third of all rows leaves at most one row per map task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .filter("_rank = 1")
        .drop("_rank")
    )


def dedupe_latest(
    df: DataFrame,
    grid: Grid,
    tiebreak: Sequence[str] = (),
    drop_null_value: bool = False,
) -> DataFrame:
    """Last-ingested row per (slot, key).

    ``drop_null_value`` drops NULL values before ranking, so an older value survives
    a newer NULL.  Without an explicit tie-break, equal ingestion times are settled
    by the larger value, so that the result never depends on row order.
    """
    if drop_null_value:
        df = df.filter(F.col(grid.value).isNotNull())
    order = [grid.ingested, *(tiebreak or [grid.value])]
    return latest_per(df, grid.keys, order)


def time_range(
    df: DataFrame,
    time: str,
    start: str | None = None,
    end: str | None = None,
    start_open: bool = False,
    end_open: bool = False,
) -> DataFrame:
    """Rows between two literal instants (ISO, UTC), which reach the file scan."""
    if start is not None:
        bound = instant(start)
        df = df.filter(F.col(time) > bound if start_open else F.col(time) >= bound)
    if end is not None:
        bound = instant(end)
        df = df.filter(F.col(time) < bound if end_open else F.col(time) <= bound)
    return df


def complete_slots(df: DataFrame, grid: Grid, n_keys: int) -> DataFrame:
    """Rows of the slots in which all ``n_keys`` keys reported.

    One shuffle by slot: keys are numbered within it, and the highest number tells how many
    there are; a slot holds one row a key, repeats aside.  NULL keys count for nothing.
    """
    slot = Window.partitionBy(grid.time)
    place = F.dense_rank().over(slot.orderBy(F.col(grid.key).asc_nulls_last()))
    numbered = df.withColumn("_place", F.when(F.col(grid.key).isNotNull(), place))
    full = numbered.withColumn("_n", F.max("_place").over(slot)).filter(F.col("_n") == n_keys)
    return full.filter(F.col(grid.time).isNotNull()).drop("_place", "_n")


def null_gate(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows in which every required column is present."""
    return df.dropna(subset=list(required))
