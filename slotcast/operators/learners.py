"""Boosted trees: fit, score, importance.

The model carries its labels and bin edges, so a stored one scores raw feature rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranks import ranked
from ..schemas import MODEL_FEATURES
from ..session import stage
from . import boosting
from .boosting import Ensemble, Inputs, Settings, best_round
from .evaluation import eval_metrics

NUMBERS = [
    "consommation_lag_24h",
    "consommation_lag_48h",
    "consommation_lag_168h",
    "consommation_rolling_168h",
    "temperature_celsius",
    "wind_speed_kmh",
    "solar_radiation_wm2",
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "is_public_holiday_fr",
    "month",
]


def fit_gbt(
    train: DataFrame,
    val: DataFrame,
    labels: Sequence[str],
    key: str = "region",
    target: str = "consommation",
    task_rows: int | None = None,
    **settings,
) -> tuple[Ensemble, int]:
    """Fit on ``train`` and keep the number of rounds with the least absolute error on ``val``.

    ``settings`` are those of ``boosting.Settings``: up to 500 rounds at 0.05, 63 leaves, a
    patience of 50.  A round is paid once.  Rows without a target are left out; missing inputs
    and unknown keys have a bin of their own.
    """
    inputs = Inputs(key, list(labels), NUMBERS)
    model = boosting.fit(train, val, inputs, target, Settings(**settings), task_rows)
    return model, len(model.trees)


def fit_alt_learner(train: DataFrame, val: DataFrame, labels: Sequence[str], **options):
    """Second learner: absolute error, with the median of the residuals in each leaf."""
    return fit_gbt(train, val, labels, loss="absolute", **options)


def score(model: Ensemble, frame: DataFrame) -> DataFrame:
    """The frame with ``predicted_mw`` appended."""
    return frame.withColumn("predicted_mw", boosting.predicted(model))


def feature_importance(model: Ensemble) -> list[tuple[str, float]]:
    """Share of all splits' gain per input feature, largest first."""
    gains = dict.fromkeys(model.inputs.names, 0.0)
    for tree in model.trees:
        for feature, gain in zip(tree.feature, tree.gain):
            if feature >= 0:
                gains[model.inputs.names[feature]] += gain
    total = sum(gains.values()) or 1.0
    return sorted(((name, gain / total) for name, gain in gains.items()), key=lambda item: (-item[1], item[0]))


def permuted(
    sample: DataFrame, ids: Sequence[str], features: Sequence[str], repeats: int, seed: int
) -> DataFrame:
    """One copy of the sample for each (feature, repeat), that feature taken from another row.

    Copies are put in the order of an MD5 of their ids; each row takes the value of the next
    one in it, the last one that of the first: a permutation of the whole sample, found by one
    global ranking for all copies.  ``ids`` name a row of the sample.
    """
    trials = F.array(
        *[F.struct(F.lit(f).alias("feature"), F.lit(r).alias("repeat")) for f in features for r in range(repeats)]
    )
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ids]
    copies = sample.withColumn("_trial", F.explode(trials)).withColumn(
        "_draw", F.md5(F.concat_ws("|", F.lit(str(seed)), "_trial.feature", F.col("_trial.repeat").cast("string"), *text))
    )
    placed = stage(ranked(copies, ["_trial", "_draw", *ids], "_place"))
    n = F.lit(sample.count())
    # Every copy has as many rows, so copies begin at the multiples of n.
    after = F.floor(F.col("_place") / n) * n + (F.col("_place") + 1) % n
    following = placed.select(F.col("_place").alias("_after"), F.struct(*features).alias("_next"))
    joined = placed.withColumn("_after", after.cast("long")).join(following, "_after")
    kept = [c for c in sample.columns if c not in features]
    return joined.select(
        "_trial", *kept,
        *[F.when(F.col("_trial.feature") == f, F.col(f"_next.{f}")).otherwise(F.col(f)).alias(f) for f in features],
    )


def permutation_importance(
    model,
    val: DataFrame,
    ids: Sequence[str],
    target: str = "consommation",
    features: Sequence[str] = tuple(MODEL_FEATURES),
    repeats: int = 5,
    fraction: float = 0.05,
    seed: int = 42,
    score_with=score,
) -> DataFrame:
    """Increase of MAE when one feature is permuted over the sample, averaged over repeats.

    ``score_with(model, frame)`` appends ``predicted_mw``; any learner will do.
    """
    lottery = F.pmod(F.xxhash64(*ids, F.lit(seed)), F.lit(1_000_000))
    columns = dict.fromkeys([*ids, target, *features])
    rows = val.filter(F.col(target).isNotNull())
    sample = stage((rows.filter(lottery < int(fraction * 1_000_000)) if fraction < 1 else rows).select(*columns))
    shuffled = permuted(sample, ids, features, repeats, seed)
    error = F.avg(F.abs(F.col("predicted_mw") - F.col(target)))
    per_trial = score_with(model, shuffled).groupBy("_trial").agg(error.alias("mae"))
    base = score_with(model, sample).agg(error).scalar()
    return (
        per_trial.withColumn("drop", F.col("mae") - base)
        .groupBy(F.col("_trial.feature").alias("feature"))
        .agg(
            F.avg("drop").alias("importance"),
            F.stddev_samp("drop").alias("importance_sd"),
            F.count("*").alias("repeats"),
        )
    )


def validation_metrics(model: Ensemble, val: DataFrame, target: str) -> DataFrame:
    return eval_metrics(score(model, val), target, "predicted_mw")


__all__ = [
    "best_round",
    "feature_importance",
    "fit_alt_learner",
    "fit_gbt",
    "permutation_importance",
    "permuted",
    "score",
    "validation_metrics",
]
