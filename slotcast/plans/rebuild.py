"""Empty all tables and compute everything again from the feeds."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..grid import Grid
from ..operators.features import hourly_mean
from ..operators.learners import score
from ..operators.training import training_frame
from ..sources.incremental import prefer_source
from ..store import Store
from .feature_job import materialize_incremental
from .forecast_job import run_forecast
from .ingest_job import load, run_backfill
from .journal import Journal
from .training_job import load_run, train


def full_rebuild(
    store: Store,
    grid: Grid,
    consumption_feeds: Sequence[DataFrame],
    weather: DataFrame,
    labels: Sequence[str],
    since: str,
    as_of: str,
    forecast_day: str,
    start: str = "1970-01-01T00:00:00",
    keys: DataFrame | None = None,
    run: str | None = None,
    **learner,
) -> str | None:
    """Truncate, backfill the preferred feeds, build features, train and forecast one day.

    The archive is read within ``[start, as_of)``, for ``keys`` where they are given.  Finished
    steps are noted in the store's journal under ``run``: called again with the same name, a
    rebuild that broke off goes on with its first open step, and one that is finished does
    nothing.  Without a name every call is a run of its own.

    Returns the id of the trained run, None if the training gate refused.
    """
    journal = Journal(store, run or uuid.uuid4().hex)

    def features() -> None:
        # A repeat starts from the given day, whatever an earlier try left.
        materialize_incremental(store, grid, as_of, since=since)

    def fit() -> str | None:
        frame = training_frame(
            store.read("features").drop("_materialized_at"),
            store.read("consumption"),
            grid,
            as_of=as_of,
            hourly=hourly_mean(store.read("weather"), grid),
        )
        return train(frame, grid, labels, store.root, as_of, **learner)

    journal.step("truncate", store.truncate)
    archive = prefer_source(consumption_feeds, grid)
    journal.step("consumption", lambda: run_backfill(store, grid, archive, start, as_of, keys))
    journal.step("weather", lambda: load(store, "weather", weather, grid))
    journal.step("features", features, ["consumption", "weather"])
    run_id = journal.step("train", fit, ["consumption", "weather", "features"])
    if run_id is not None:

        def forecast() -> None:
            model = load_run(store.spark, store.root, run_id)
            run_forecast(store, grid, forecast_day, labels, lambda f: score(model, f), run_id, as_of)

        journal.step("forecast", forecast, ["consumption", "weather", "features"])
    return run_id
