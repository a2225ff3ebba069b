"""Queries behind a monitoring page: recent rows, freshness, rankings, day views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numeric
from ..functions.calendar import local_time
from ..functions.timegrid import instant, shift
from ..grid import DAY, HOUR, Grid
from .clean import complete_slots
from .quality import TOTAL_LABEL

# Seconds below which a table counts as fresh, then as late.
FRESHNESS = {"continuous": (20 * 60, 60 * 60), "daily": (26 * HOUR, 30 * HOUR)}

# Which tables are written once a day.
CADENCE = {
    "ingest": "continuous",
    "features": "daily",
    "forecast": "daily",
    "train": "daily",
    "eval": "continuous",
}

# Short names for long labels in the heatmap.
SHORT_NAMES = {
    "Provence-Alpes-Côte d'Azur": "PACA",
    "Auvergne-Rhône-Alpes": "Auvergne-RA",
    "Bourgogne-Franche-Comté": "Bourgogne-FC",
    "Centre-Val de Loire": "Centre-VdL",
}


def recent_forecasts(
    predictions: DataFrame, grid: Grid, as_of: str, back_hours: int = 48, ahead_hours: int = 24
) -> DataFrame:
    now = instant(as_of)
    low, high = shift(now, -back_hours * HOUR), shift(now, ahead_hours * HOUR)
    return (
        predictions.filter(F.col("forecast_horizon_dt").between(low, high))
        .select("forecast_horizon_dt", grid.key, "predicted_mw", "model_version", "forecasted_at")
        .orderBy("forecast_horizon_dt", grid.key)
    )


def recent_actuals(
    series: DataFrame, grid: Grid, as_of: str, n_keys: int | None, hours: int = 48
) -> DataFrame:
    """Values of the last hours, on complete slots only when ``n_keys`` is given."""
    rows = series.filter(
        (F.col(grid.time) >= shift(instant(as_of), -hours * HOUR))
        & F.col(grid.value).isNotNull()
    ).select(*grid.keys, grid.value)
    if n_keys is not None:
        rows = complete_slots(rows, grid, n_keys)
    return rows.orderBy(*grid.keys)


def system_status(stamps: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row with the latest stamp of each table; partial maxima only are shuffled."""
    parts = [
        table.agg(F.max(column).alias("at")).select(F.lit(name).alias("name"), "at")
        for name, (table, column) in stamps.items()
    ]
    long = reduce(DataFrame.unionByName, parts)
    return long.agg(
        *[F.max(F.when(F.col("name") == n, F.col("at"))).alias(f"last_{n}") for n in stamps]
    )


def age_text(age: Column) -> Column:
    """Seconds as a short text."""
    minutes = F.floor(age / 60)
    return (
        F.when(age.isNull(), F.lit("—"))
        .when(minutes < 1, F.lit("just now"))
        .when(minutes < 60, F.concat(minutes.cast("string"), F.lit(" min ago")))
        .when(
            minutes < 1440,
            F.concat(
                F.floor(minutes / 60).cast("string"),
                F.lit(" h "),
                (minutes % 60).cast("string"),
                F.lit(" min ago"),
            ),
        )
        .otherwise(F.concat(F.floor(minutes / 1440).cast("string"), F.lit(" d ago")))
    )


def freshness_class(age: Column, cadence: str) -> Column:
    fresh, late = FRESHNESS[cadence]
    return F.when(age < fresh, F.lit("ok")).when(age < late, F.lit("warn")).otherwise(F.lit("dead"))


def freshness(status: DataFrame, as_of: str, cadence: dict[str, str] | None = None) -> DataFrame:
    """Class and age text per table, from the one-row status."""
    cadence = cadence or CADENCE
    names = [c.removeprefix("last_") for c in status.columns]
    long = status.unpivot([], status.columns, "name", "last_at").withColumn(
        "name", F.expr("substring(name, 6)")
    )
    seconds_old = (
        F.unix_micros(instant(as_of)) - F.unix_micros(F.col("last_at").cast("timestamp"))
    ) / F.lit(1e6)
    classed = reduce(
        lambda column, name: column.when(
            F.col("name") == name, freshness_class(F.col("age_s"), cadence[name])
        ),
        names[1:],
        F.when(F.col("name") == names[0], freshness_class(F.col("age_s"), cadence[names[0]])),
    )
    return (
        long.withColumn("age_s", seconds_old)
        .withColumn("class", classed)
        .withColumn("age", age_text(F.col("age_s")))
    )


def latest_metrics(metrics: DataFrame, key: str) -> DataFrame:
    """Rows of the newest computation day (scalar subquery, evaluated once)."""
    newest = metrics.agg(F.max("computed_date")).scalar()
    return (
        metrics.filter(F.col("computed_date") == newest)
        .select(key, "mae_mw", "p95_error_mw", "p99_error_mw", "n_samples", "computed_date")
        .orderBy(key)
    )


def metrics_history(
    metrics: DataFrame, key: str, as_of_day: str, days: int = 30, label: str = TOTAL_LABEL
) -> DataFrame:
    """MAE per key and day, national rows marked."""
    since = F.date_sub(F.lit(as_of_day).cast("date"), days)
    return (
        metrics.filter(F.col("computed_date") >= since)
        .select(key, "computed_date", "mae_mw", (F.col(key) == label).alias("is_national"))
        .orderBy("computed_date", key)
    )


def completeness(
    series: DataFrame, grid: Grid, as_of: str, n_keys: int, hours: int = 24
) -> DataFrame:
    """Distinct (slot, key) with a value over the expected number, in percent."""
    expected = hours * HOUR // grid.step * n_keys
    return (
        series.filter(
            (F.col(grid.time) >= shift(instant(as_of), -hours * HOUR))
            & F.col(grid.value).isNotNull()
        )
        .select(*grid.keys)
        .distinct()
        .agg(F.count("*").alias("n_slots"))
        .withColumn("pct", F.round(F.col("n_slots") * 100.0 / F.lit(float(expected)), 1))
    )


def next_slot_total(predictions: DataFrame, grid: Grid, as_of: str) -> DataFrame:
    """Sum over keys at the first slot after now; NULL if there is none."""
    future = predictions.filter(F.col("forecast_horizon_dt") > instant(as_of))
    per_slot = future.groupBy("forecast_horizon_dt").agg(
        numeric.free_total("predicted_mw", grid.scale).alias("total")
    )
    return per_slot.agg(
        F.min("forecast_horizon_dt").alias("slot"),
        F.min_by("total", "forecast_horizon_dt").alias("total_mw"),
    )


def latest_batch(predictions: DataFrame) -> DataFrame:
    """When the newest batch was made, and the first 8 characters of its model version."""
    order = F.struct("forecasted_at", "model_version")
    return predictions.agg(
        F.max("forecasted_at").alias("forecasted_at"),
        F.substring(F.coalesce(F.max_by("model_version", order), F.lit("")), 1, 8).alias("model"),
    )


def mean_by_key(predictions: DataFrame, grid: Grid) -> DataFrame:
    """Average prediction per key with the bounds of a colour scale."""
    means = predictions.groupBy(grid.key).agg(
        numeric.free_mean("predicted_mw", grid.scale).alias("avg_mw")
    )
    low = means.agg(F.min("avg_mw") * 0.85).scalar()
    high = means.agg(F.max("avg_mw") * 1.05).scalar()
    return means.withColumn("scale_min", low).withColumn("scale_max", high)


def day_view(
    predictions: DataFrame,
    actuals: DataFrame,
    grid: Grid,
    as_of: str,
    key: str | None = None,
) -> DataFrame:
    """Actual, predicted and the previous day's actual per slot of the UTC day.

    ``key=None`` sums over keys.  The three series are stacked and aggregated by slot,
    which is the full outer join without joining.
    """
    day_start = F.date_trunc("day", instant(as_of))
    day_end = shift(day_start, DAY)
    if key is not None:
        predictions = predictions.filter(F.col(grid.key) == key)
        actuals = actuals.filter(F.col(grid.key) == key)
    actuals = actuals.filter(F.col(grid.value).isNotNull())
    today = actuals.select(
        F.col(grid.time).alias("slot"), F.col(grid.value).alias("actual")
    )
    predicted = predictions.select(
        F.col("forecast_horizon_dt").alias("slot"), F.col("predicted_mw").alias("predicted")
    )
    yesterday = actuals.select(
        shift(grid.time, DAY).alias("slot"), F.col(grid.value).alias("yesterday")
    )
    inside = (F.col("slot") >= day_start) & (F.col("slot") < day_end)
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [s.filter(inside) for s in (today, predicted, yesterday)],
    )
    return stacked.groupBy("slot").agg(
        *[numeric.free_total(c, grid.scale).alias(c) for c in ("actual", "predicted", "yesterday")]
    ).orderBy("slot")


def mae_ranking(metrics: DataFrame, key: str, label: str = TOTAL_LABEL) -> DataFrame:
    """Latest MAE per key without the national row, best first."""
    return (
        latest_metrics(metrics, key)
        .filter((F.col(key) != label) & F.col("mae_mw").isNotNull())
        .select(key, "mae_mw")
        .orderBy("mae_mw", key)
    )


def hour_heatmap(predictions: DataFrame, grid: Grid) -> DataFrame:
    """Mean prediction by key and local hour, 24 columns, largest row total first.

    One mean for each key and hour; at most 24 rows a key are then turned into columns.
    """
    hour = F.hour(local_time("forecast_horizon_dt", grid.tz))
    names = [f"h{h:02d}" for h in range(24)]
    means = predictions.groupBy(grid.key, hour.alias("_hour")).agg(
        numeric.free_mean(F.col("predicted_mw"), grid.scale).alias("_mean")
    )
    table = means.groupBy(grid.key).agg(
        *[F.max(F.when(F.col("_hour") == h, F.col("_mean"))).alias(n) for h, n in enumerate(names)]
    )
    row_total = reduce(lambda a, b: a + b, [F.coalesce(n, F.lit(0.0)) for n in names])
    label = F.col(grid.key)
    for name, short in SHORT_NAMES.items():
        label = F.when(F.col(grid.key) == name, F.lit(short)).otherwise(label)
    return (
        table.withColumn("label", label)
        .withColumn("row_total", row_total)
        .orderBy(F.desc("row_total"), grid.key)
    )


def kpi_strip(
    metrics: DataFrame,
    predictions: DataFrame,
    series: DataFrame,
    grid: Grid,
    as_of: str,
    n_keys: int,
    label: str = TOTAL_LABEL,
) -> DataFrame:
    """National MAE, p95 and sample count with completeness and the next total, one row."""
    national = latest_metrics(metrics, grid.key).filter(F.col(grid.key) == label)
    filled = completeness(series, grid, as_of, n_keys)
    upcoming = next_slot_total(predictions, grid, as_of)
    return national.agg(
        F.max("mae_mw").alias("mae_mw"),
        F.max("p95_error_mw").alias("p95_error_mw"),
        F.coalesce(F.max("n_samples"), F.lit(0)).alias("n_samples"),
    ).select(
        "*",
        filled.select("pct").scalar().alias("completeness_pct"),
        upcoming.select("total_mw").scalar().alias("next_total_mw"),
    )


def prediction_audit(predictions: DataFrame, since: str) -> DataFrame:
    """Number of predictions by horizon day and day made."""
    return (
        predictions.filter(F.col("forecast_horizon_dt") >= instant(since))
        .groupBy(
            F.to_date("forecast_horizon_dt").alias("day"),
            F.to_date("forecasted_at").alias("made_on"),
        )
        .agg(F.count("*").alias("n"))
        .orderBy("day", "made_on")
    )


def smoke_checks(
    raw: DataFrame, predictions: DataFrame, grid: Grid, as_of: str, fresh_hours: int = 2
) -> DataFrame:
    """Post-deployment checks as rows: name, matching rows, passed, failures overall."""
    now = instant(as_of)
    yesterday = F.date_sub(F.to_date(local_time(now, grid.tz)), 1)
    fresh = raw.filter(F.col(grid.time) > shift(now, -fresh_hours * HOUR))
    recent = predictions.filter(F.col("forecast_date") >= yesterday)
    checks = [("raw_fresh", fresh), ("predictions_recent", recent)]
    rows = reduce(
        DataFrame.unionByName,
        [d.agg(F.count("*").alias("n")).select(F.lit(c).alias("check"), "n") for c, d in checks],
    ).withColumn("ok", F.col("n") > 0)
    failures = rows.agg(F.count_if(~F.col("ok"))).scalar()
    return rows.withColumn("failures", failures)
