"""Streaming forms: keyed upsert, windowed means, repeat suppression, rolling metrics.

Sources are landed files; every query takes its checkpoint folder from the caller and
runs as one incremental batch or, with another ``trigger``, continuously.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..grid import Grid
from ..operators.clean import latest_per
from ..operators.validate import Rules, validate
from ..plans.metrics_job import run_metrics
from ..schemas import WEATHER_MEASURES
from ..store import Store

# One pass over what has landed; ``{"processingTime": "1 minute"}`` runs on.
ONCE = {"availableNow": True}

# Fixed value: how late a row may be.
LATE = "6 hours"


def read_landed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """New Parquet files of a landing folder as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def stream_upsert(
    source: DataFrame,
    store: Store,
    table: str,
    grid: Grid,
    checkpoint: str,
    rules: Rules | None = None,
    policy: str = "fail",
    trigger: Mapping[str, object] = ONCE,
) -> StreamingQuery:
    """Upsert every micro-batch by key, the latest ingestion winning, however late it is.

    A batch replayed after a failure gives the same table.
    """

    def write(batch: DataFrame, _: int) -> None:
        rows = validate(batch, rules, policy) if rules else batch
        keys = store.layout(table).upsert_keys
        newest = latest_per(rows, keys, [grid.ingested, *_values(rows, grid, keys)])
        store.upsert(table, newest, newest_by=grid.ingested)

    return (
        source.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def _values(rows: DataFrame, grid: Grid, keys: Sequence[str]) -> list[str]:
    """Tie-break columns: whatever is neither key nor stamp."""
    return [c for c in rows.columns if c not in {*keys, grid.ingested}]


def stream_hourly(
    source: DataFrame,
    grid: Grid,
    late: str = LATE,
    measures: Sequence[str] = WEATHER_MEASURES,
) -> DataFrame:
    """Hourly means per key; an hour is final once the watermark passes its end.

    Partial aggregates are the only state, one per open (hour, key).
    """
    return (
        source.withWatermark(grid.time, late)
        .groupBy(F.window(grid.time, "1 hour"), F.col(grid.key))
        .agg(*[F.avg(m).alias(m) for m in measures])
        .select(F.col("window.start").alias("hour_dt"), grid.key, *measures)
    )


def stream_dedupe(source: DataFrame, time: str, keys: Sequence[str], late: str = LATE) -> DataFrame:
    """First occurrence of a record fetched again within ``late``; for identical repeats."""
    return source.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def stream_metrics(
    source: DataFrame,
    store: Store,
    grid: Grid,
    as_of: str | Callable[[], str],
    n_keys: int,
    checkpoint: str,
    trigger: Mapping[str, object] = ONCE,
) -> StreamingQuery:
    """Land each micro-batch of actuals, then refresh the day's metrics snapshot.

    ``as_of`` may be a function, which is asked for every batch: in a stream that lives on,
    the evaluation window moves with it.
    """

    def write(batch: DataFrame, _: int) -> None:
        keys = store.layout("consumption").upsert_keys
        newest = latest_per(batch, keys, [grid.ingested, *_values(batch, grid, keys)])
        store.upsert("consumption", newest, newest_by=grid.ingested)
        run_metrics(store, grid, as_of() if callable(as_of) else as_of, n_keys)

    return (
        source.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query and raise what it raised."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def write_files(
    stream: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object] = ONCE
) -> StreamingQuery:
    """Append finished rows to a Parquet folder, exactly once."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )
