"""Training frame to stored model and run log."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import exists
from ..functions.timegrid import instant
from ..grid import Grid
from ..operators import boosting
from ..operators.learners import fit_gbt, validation_metrics
from ..operators.training import MIN_ROWS, VAL_FRACTION, enough_rows, latest_run, time_split
from ..schemas import MODEL_FEATURES, RUN_LOG
from ..session import staged


def log_run(spark: SparkSession, path: str, created_at: str, **facts) -> None:
    """Append one row to the run log."""
    row = spark.range(1).select(
        instant(created_at).alias("created_at"),
        *[F.lit(value).alias(name) for name, value in facts.items()],
    )
    row = row.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RUN_LOG.fields])
    row.coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], RUN_LOG)
    return spark.read.schema(RUN_LOG).parquet(path)


def train(
    frame: DataFrame,
    grid: Grid,
    labels: Sequence[str],
    root: str,
    created_at: str,
    val_fraction: float = VAL_FRACTION,
    min_rows: int = MIN_ROWS,
    **options,
) -> str | None:
    """Split, fit, store the model under ``root`` and log the run; None below the gate."""
    with staged(frame) as rows:
        if not enough_rows(rows, min_rows):
            return None
        return _train(rows, grid, labels, root, created_at, val_fraction, options)


def _train(
    frame: DataFrame,
    grid: Grid,
    labels: Sequence[str],
    root: str,
    created_at: str,
    val_fraction: float,
    options: dict,
) -> str:
    spark = frame.sparkSession
    run_id = uuid.uuid4().hex
    split = time_split(frame, grid.time, val_fraction)
    train_rows, val_rows = (split.filter(F.col("split") == s) for s in ("train", "val"))
    model, best = fit_gbt(train_rows, val_rows, labels, grid.key, grid.value, **options)
    counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    quality = validation_metrics(model, val_rows, grid.value).first()
    artifact = f"{root}/models/{run_id}"
    boosting.save(spark, model, artifact)
    log_run(
        spark,
        f"{root}/runs",
        created_at,
        run_id=run_id,
        n_train=counts.get("train", 0),
        n_val=counts.get("val", 0),
        val_fraction=val_fraction,
        features=list(MODEL_FEATURES),
        n_features=len(MODEL_FEATURES),
        best_iteration=best,
        val_mae_mw=quality["mae"],
        val_rmse_mw=quality["rmse"],
        artifact=artifact,
    )
    return run_id


def load_run(spark: SparkSession, root: str, run_id: str) -> boosting.Ensemble:
    return boosting.load(spark, f"{root}/models/{run_id}")


def load_latest(spark: SparkSession, root: str) -> tuple[str, boosting.Ensemble]:
    """Newest run of the log and its model."""
    run = latest_run(read_runs(spark, f"{root}/runs"), "run_id", "created_at").first()
    if run is None or run["run_id"] is None:
        raise LookupError(f"no run logged under {root}")
    return run["run_id"], load_run(spark, root, run["run_id"])
