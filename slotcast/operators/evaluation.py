"""Model quality: error metrics, comparison, samples, errors per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric


def eval_metrics(
    df: DataFrame,
    actual: str,
    predicted: str,
    by: Sequence[str] = (),
    scale: int | None = None,
    digits: int = 2,
) -> DataFrame:
    """MAE, RMSE and R2 in one aggregate, rounded; optionally per group."""
    error = F.col(predicted) - F.col(actual)
    pairs = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    squared = numeric.mean_square(error, scale)
    spread = F.var_pop(actual)
    return pairs.groupBy(*by).agg(
        F.round(numeric.free_mean(F.abs(error), scale), digits).alias("mae"),
        F.round(F.sqrt(squared), digits).alias("rmse"),
        F.round(1 - squared / F.nullif(spread, F.lit(0.0)), digits).alias("r2"),
        F.count("*").alias("n"),
    )


def compare_models(
    df: DataFrame, actual: str, models: dict[str, str], scale: int | None = None
) -> DataFrame:
    """Metrics of several prediction columns side by side, the best per metric flagged.

    The columns are unpivoted in place and aggregated by model: one scan, one shuffle
    of one row per model and task.
    """
    wide = df.select(actual, *[F.col(c).alias(m) for m, c in models.items()])
    long = wide.unpivot([actual], list(models), "model", "predicted")
    table = eval_metrics(long, actual, "predicted", ["model"], scale)
    every = Window.partitionBy(F.lit(1))  # one row per model
    return table.withColumns(
        {
            "best_mae": F.col("mae") == F.min("mae").over(every),
            "best_rmse": F.col("rmse") == F.min("rmse").over(every),
            "best_r2": F.col("r2") == F.max("r2").over(every),
        }
    )


def prediction_error_sample(
    df: DataFrame,
    actual: str,
    predicted: str,
    ids: Sequence[str],
    n: int = 5000,
    seed: int = 42,
) -> DataFrame:
    """Seeded sample of ``n`` rows with residuals; a distributed top-k by MD5 of the ids.

    The digest is of the ids and the seed as text, so other engines draw the same rows.
    """
    lottery = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in ids], F.lit(str(seed))))
    return (
        df.select(
            *ids,
            F.col(actual).alias("actual"),
            F.col(predicted).alias("predicted"),
            (F.col(actual) - F.col(predicted)).alias("residual"),
        )
        .orderBy(lottery, *ids)
        .limit(n)
    )


def mae_by_key(
    df: DataFrame, actual: str, predicted: str, key: str, scale: int | None = None
) -> DataFrame:
    """Mean absolute error per key, worst first."""
    error = F.abs(F.col(predicted) - F.col(actual))
    return (
        df.groupBy(key)
        .agg(numeric.free_mean(error, scale).alias("mae"))
        .orderBy(F.desc("mae"), key)
    )
