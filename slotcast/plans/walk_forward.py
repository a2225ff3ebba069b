"""Learned walk-forward: a refit for every day, many days side by side, with a ledger.

The training rows of a day are a fold.  Folds are independent: each is one group of a
co-grouped job that fits the fold and forecasts its day in one task.  Days go in batches; a
day counts as done once its run stands in the ledger, so a run that was broken off goes on
with the days that are open.  Folds beyond the rows of a task are fitted over all tasks.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..files import exists
from ..functions.timegrid import seconds
from ..grid import DAY, HOUR, Grid
from ..operators import boosting
from ..operators.boosting import Ensemble, Inputs, Settings
from ..operators.clean import latest_per
from ..operators.learners import NUMBERS, score
from ..operators.training import HORIZON_HOURS, LOOKBACK_DAYS, MIN_ROWS, VAL_FRACTION
from ..schemas import MODEL_FEATURES, RUN_LOG
from ..session import staged
from ..sources.periods import days_between
from ..store import Store
from .backtest import fold_days
from .forecast_job import stamp_predictions

#: Days of one job: bounds the copies of training rows that are moved at once.
DAYS_PER_JOB = 64

LEDGER = T.StructType([T.StructField("forecast_date", T.DateType(), False), *RUN_LOG.fields])


@dataclass(frozen=True)
class Folds:
    """How the folds of a walk-forward are cut."""

    lookback_days: int = LOOKBACK_DAYS
    horizon_hours: int = HORIZON_HOURS
    val_fraction: float = VAL_FRACTION
    min_rows: int = MIN_ROWS
    task_rows: int = boosting.TASK_ROWS


def fold_rows(frame: DataFrame, folds: DataFrame, grid: Grid, cut: Folds) -> DataFrame:
    """Each training row once for every fold (forecast_date, cutoff) that may know it."""
    at = F.col(grid.time)
    bounds = folds.agg(F.min("forecast_date"), F.max("forecast_date")).first()
    first, last = (F.lit(day) for day in bounds)
    day = F.to_date(at)
    low = F.greatest(F.date_add(day, cut.horizon_hours // 24), first)
    high = F.least(F.date_add(day, cut.lookback_days + 2), last)
    copies = frame.filter(low <= high).withColumn("forecast_date", F.explode(days_between(low, high)))
    return copies.join(folds, "forecast_date").filter(
        (seconds(at) >= F.col("cutoff") - cut.lookback_days * DAY)
        & (seconds(at) < F.col("cutoff") - cut.horizon_hours * HOUR)
    )


def split_point(micros: np.ndarray, val_fraction: float) -> int:
    """Rows after it are validation rows; a cut of the time range, as ``time_split`` makes it."""
    low, high = int(micros.min()), int(micros.max())
    return low + int(np.floor((high - low) * (1 - val_fraction)))


def run_id_of(name: str, day: str) -> str:
    return hashlib.md5(f"{name}|{day}".encode()).hexdigest()


_RESULT = [
    ("run_id", pa.string(), "string"),
    ("n_train", pa.int64(), "long"),
    ("n_val", pa.int64(), "long"),
    ("val_mae_mw", pa.float64(), "double"),
    ("val_rmse_mw", pa.float64(), "double"),
    ("place", pa.int64(), "long"),
    ("predicted_mw", pa.float64(), "double"),
    ("node", None, f"struct<{', '.join(p.replace(' ', ':', 1) for p in boosting.NODES_DDL.split(', '))}>"),
]


def _fit_and_forecast(inputs: Inputs, settings: Settings, cut: Folds, name: str):
    """Group task: the day's model, its forecast by place, its nodes, and one row of facts."""
    fields = [p.split() for p in boosting.NODES_DDL.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string()}
    node = pa.struct([(n, kinds[k]) for n, k in fields])
    schema = pa.schema([("forecast_date", pa.date32()), *[(n, t or node) for n, t, _ in _RESULT]])
    width = len(inputs.names)

    def task(key, rows: pa.Table, slots: pa.Table) -> pa.Table:
        if rows.num_rows < cut.min_rows:
            return schema.empty_table()
        day = key[0].as_py()
        rows = rows.sort_by([("micros", "ascending"), ("draw", "ascending")])
        columns, y, draw = boosting.arrays_of(rows, width)
        micros = rows.column("micros").to_numpy()
        val = micros > split_point(micros, cut.val_fraction)
        model = boosting.fit_arrays(columns, y, draw, val, inputs, settings)
        error = y[val] - model.predict(model.inputs.bins([c[val] for c in columns]))
        facts = {
            "forecast_date": day, "run_id": run_id_of(name, str(day)), "n_train": int((~val).sum()), "n_val": int(val.sum()),
            "val_mae_mw": float(np.abs(error).mean()) if len(error) else None,
            "val_rmse_mw": float(np.sqrt((error**2).mean())) if len(error) else None,
        }
        blank = dict.fromkeys(schema.names) | {"forecast_date": day, "run_id": facts["run_id"]}
        out = [blank | facts]
        names = [n for n, _ in fields]
        out += [blank | {"node": dict(zip(names, row))} for row in model.node_rows()]
        if slots.num_rows:
            xs, _, _ = boosting.arrays_of(slots, width)
            values = model.predict(model.inputs.bins(xs)).tolist()
            out += [blank | {"place": p, "predicted_mw": v} for p, v in zip(slots.column("place").to_pylist(), values)]
        return pa.Table.from_pylist(out, schema)

    return task


def fit_days(frame: DataFrame, slots: DataFrame, folds: DataFrame, grid: Grid, inputs: Inputs, settings: Settings, cut: Folds, name: str) -> DataFrame:
    """Facts, nodes and predictions of every fold, one group of a co-grouped job each."""
    xs = [c.alias(f"x{k}") for k, c in enumerate(inputs.columns())]
    rows = fold_rows(frame, folds, grid, cut).select(
        "forecast_date", *xs, F.col(grid.value).cast("double").alias("y"),
        F.unix_micros(F.col(grid.time).cast("timestamp")).alias("micros"), F.xxhash64(*frame.columns).alias("draw"),
    )
    asked = slots.select("forecast_date", *xs, F.lit(None).cast("double").alias("y"), F.lit(0).cast("long").alias("draw"), "place")
    ddl = "forecast_date date, " + ", ".join(f"{n} {k}" for n, _, k in _RESULT)
    return (
        rows.groupBy("forecast_date")
        .cogroup(asked.groupBy("forecast_date"))
        .applyInArrow(_fit_and_forecast(inputs, settings, cut, name), ddl)
    )


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/walk_forward/runs"
    return spark.read.schema(LEDGER).parquet(path) if exists(spark, path) else spark.createDataFrame([], LEDGER)


def load_model(spark: SparkSession, root: str, run_id: str) -> Ensemble:
    return boosting.load(spark, f"{root}/walk_forward/models/run_id={run_id}")


def _all_days(first_day: str, last_day: str) -> list[str]:
    first, last = date.fromisoformat(first_day), date.fromisoformat(last_day)
    return [(first + timedelta(days=k)).isoformat() for k in range((last - first).days + 1)]


def walk_forward(
    store: Store,
    frame: DataFrame,
    slots: DataFrame,
    keys: DataFrame,
    grid: Grid,
    labels: Sequence[str],
    first_day: str,
    last_day: str,
    name: str | None = None,
    cut: Folds | None = None,
    days_per_job: int = DAYS_PER_JOB,
    **settings,
) -> list[str]:
    """Refit and forecast every day of a range that is not in the ledger; returns the days tried.

    ``frame`` holds the training rows of all days (features, target), ``slots`` the model
    inputs of all forecast days, ``keys`` any frame of the session.  A fold trains on what lies
    ``horizon_hours`` before its cutoff; days below ``min_rows`` are left out, as are days
    without rows.  Each day has a run id, a stored model and a ledger row; its predictions
    carry the id and are upserted.  Where two days predict a slot the later one wins.
    """
    spark, cut, chosen = store.spark, cut or Folds(), Settings(**settings)
    name = name or uuid.uuid4().hex
    inputs = Inputs(grid.key, list(labels), NUMBERS)
    done = {str(r["forecast_date"]) for r in read_ledger(spark, store.root).select("forecast_date").collect()}
    days = [day for day in _all_days(first_day, last_day) if day not in done]
    with staged(slots.withColumn("place", F.monotonically_increasing_id())) as placed:
        for at in range(0, len(days), days_per_job):
            batch = days[at : at + days_per_job]
            folds = fold_days(keys, batch[0], batch[-1], grid.tz).filter(F.col("forecast_date").cast("string").isin(batch))
            own = placed.filter(F.col("forecast_date").cast("string").isin(batch))
            sizes = fold_rows(frame, folds, grid, cut).groupBy("forecast_date").count()
            large = [str(r["forecast_date"]) for r in sizes.filter(F.col("count") > cut.task_rows).collect()]
            small = folds.filter(~F.col("forecast_date").cast("string").isin(large)) if large else folds
            with staged(fit_days(frame, own, small, grid, inputs, chosen, cut, name)) as made:
                _keep(store, grid, made, own, cut)
            for day in large:
                _large_day(store, frame, own, folds, grid, inputs, chosen, cut, name, day)
    return days


def _keep(store: Store, grid: Grid, made: DataFrame, slots: DataFrame, cut: Folds) -> None:
    """Models, predictions, then the ledger: what is in the ledger is complete."""
    models = f"{store.root}/walk_forward/models"
    nodes = made.filter("node IS NOT NULL").select("run_id", "node.*")
    # One file a model: a few thousand rows.
    nodes.repartition("run_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(models)
    found = made.filter("place IS NOT NULL").select("place", "run_id", "predicted_mw")
    rows = stamp_predictions(slots.join(found, "place"), grid, F.col("run_id"), F.col("forecast_date"), F.col("anchor"))
    store.upsert("predictions", latest_per(rows, ["forecast_horizon_dt", grid.key], ["forecast_date"]))
    rounds = made.filter("node.tree >= 0 AND node.node = 0").groupBy("run_id").agg(F.count("*").alias("best_iteration"))
    facts = made.filter("n_train IS NOT NULL").select("forecast_date", "run_id", "n_train", "n_val", "val_mae_mw", "val_rmse_mw")
    ledger = facts.join(rounds, "run_id", "left").withColumns(
        {
            "created_at": F.current_timestamp(),
            "val_fraction": F.lit(cut.val_fraction),
            "features": F.array(*[F.lit(f) for f in MODEL_FEATURES]),
            "n_features": F.lit(len(MODEL_FEATURES)),
            "artifact": F.concat(F.lit(f"{models}/run_id="), "run_id"),
        }
    )
    ledger.select(*[F.col(f.name).cast(f.dataType) for f in LEDGER.fields]).coalesce(1).write.mode("append").parquet(
        f"{store.root}/walk_forward/runs"
    )


def _large_day(store, frame, slots, folds, grid, inputs, settings, cut, name, day) -> None:
    """A fold beyond the rows of a task, fitted over all tasks, kept like the others."""
    spark, own = store.spark, folds.filter(F.col("forecast_date") == F.lit(day).cast("date"))
    micros = F.unix_micros(F.col(grid.time).cast("timestamp"))
    with staged(fold_rows(frame, own, grid, cut).withColumn("_at", micros)) as rows:
        low, high, n = rows.agg(F.min("_at"), F.max("_at"), F.count("*")).first()
        if n < cut.min_rows:
            return
        val = F.col("_at") > split_point(np.array([low, high]), cut.val_fraction)
        train, held = rows.filter(~val), rows.filter(val)
        model = boosting.fit(train, held, inputs, grid.value, settings, task_rows=cut.task_rows)
        error = F.col("predicted_mw") - F.col(grid.value)
        n_val, mae, square = score(model, held).agg(F.count("*"), F.avg(F.abs(error)), F.avg(error * error)).first()
        run_id = run_id_of(name, day)
        columns = "forecast_date date, " + ", ".join(f"{c} {k}" for c, _, k in _RESULT)
        today = date.fromisoformat(day)
        facts = [(today, run_id, n - n_val, n_val, mae, square**0.5 if n_val else None, None, None, None)]
        facts += [(today, run_id, *[None] * 6, row) for row in model.node_rows()]
        wanted = slots.filter(F.col("forecast_date") == F.lit(day).cast("date"))
        blank = [F.lit(None).cast(k).alias(c) for c, _, k in _RESULT[1:5]]
        forecast = score(model, wanted).select(
            "forecast_date", F.lit(run_id).alias("run_id"), *blank, "place", "predicted_mw", F.lit(None).cast(_RESULT[-1][2]).alias("node")
        )
        with staged(spark.createDataFrame(facts, columns).union(forecast)) as made:
            _keep(store, grid, made, wanted, cut)


__all__ = ["Folds", "fit_days", "fold_rows", "load_model", "read_ledger", "walk_forward"]
