"""Every operator as a query over the test tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bindings as b
from .bindings import AS_OF, DAILY, DAILY_AS_OF, HOURLY, N_KEYS, USERS
from .functions import calendar as cal
from .grid import DAY, Grid
from .operators import (
    clean,
    evaluation,
    features,
    horizon,
    learners,
    monitor,
    quality,
    tables,
    training,
    validate,
)
from .plans import (
    backtest,
    feature_job,
    forecast_job,
    ingest_job,
    journal,
    metrics_job,
    rebuild,
    training_job,
)
from .plans import walk_forward as walk_forward_plan
from .schemas import CONSUMPTION, WEATHER
from .session import prepare, shared_folder, stage
from .sources import dimensions, incremental, landed, periods
from .store import Store
from .streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TIE = ["event_id"]
LABELS = ["click", "error", "purchase", "signup", "view"]
DAILY_UTC = Grid(step=DAY, scale=2, tz="UTC")


def portable(df: DataFrame) -> DataFrame:
    """Instants as zone-free timestamps, for comparison with other engines."""
    stamps = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps}) if stamps else df


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(function(prepare(spark), sf_dir))

    QUERIES[function.__name__] = run
    return run


# --- shared inputs -------------------------------------------------------------------


def day_range(rows: DataFrame, time: str = "date_heure", later: int = 0) -> tuple[str, str]:
    """First and last UTC day that hold a row, by one min/max aggregate, moved by ``later`` days.

    A table without rows has no keys either, so its one day gives no slots.
    """
    low, high = rows.agg(
        *[F.date_add(F.coalesce(f(time).cast("date"), F.lit("1970-01-01").cast("date")), later) for f in (F.min, F.max)]
    ).first()
    return low.isoformat(), high.isoformat()


def event_days(spark: SparkSession, sf: str, later: int = 0) -> tuple[str, str]:
    return day_range(b.events(spark, sf).select(F.col("ts").cast("timestamp").alias("ts")), "ts", later)


def order_days(spark: SparkSession, sf: str, later: int = 0) -> tuple[str, str]:
    return day_range(b.table(spark, sf, "orders"), "o_orderdate", later)


def eco(spark: SparkSession, sf: str) -> DataFrame:
    """Deduplicated hourly series."""
    return clean.dedupe_latest(b.consumption(spark, sf), HOURLY, TIE)


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    return features.hourly_mean(b.weather(spark, sf), HOURLY)


def feature_rows(spark: SparkSession, sf: str) -> DataFrame:
    return feature_job.build_features(
        b.consumption(spark, sf), b.weather(spark, sf), HOURLY, tiebreak=TIE
    )


def train_rows(spark: SparkSession, sf: str, exog_at: str = "target_time", **options) -> DataFrame:
    return training.training_frame(
        feature_rows(spark, sf),
        b.consumption(spark, sf),
        HOURLY,
        as_of=None if "cutoff" in options else options.pop("as_of", AS_OF),
        exog_at=exog_at,
        hourly=hourly(spark, sf),
        tiebreak=TIE,
        **options,
    )


def frame_rows(spark: SparkSession, sf: str, **options) -> DataFrame:
    return forecast_job.forecast_frame(
        eco(spark, sf), hourly(spark, sf), b.keys(spark, sf), *event_days(spark, sf), HOURLY, **options
    )


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Naive predictions of every day; only lags are computed, not the whole frame."""
    slots = horizon.scaffold(b.keys(spark, sf), *event_days(spark, sf), HOURLY)
    rows = horizon.lag_fallback(
        horizon.aligned_lags(slots, eco(spark, sf), HOURLY, lags=(24, 48)), HOURLY
    )
    scored = forecast_job.naive_forecast(rows, "consommation_lag_24h")
    return forecast_job.stamp_predictions(
        scored.filter(F.col("predicted_mw").isNotNull()),
        HOURLY,
        F.lit("naive24"),
        F.col("forecast_date"),
        F.col("anchor"),
    )


def metrics(spark: SparkSession, sf: str) -> DataFrame:
    matched = quality.match_all(predictions(spark, sf), b.consumption(spark, sf), HOURLY, TIE)
    return quality.metrics_backfill(matched, HOURLY, N_KEYS, *event_days(spark, sf, later=1))


def stored_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The metrics as a stored table, for queries that read them more than once."""
    return stage(metrics(spark, sf))


def rounded(df: DataFrame) -> DataFrame:
    """Interpolated percentiles to 4 decimals: engines differ in the last bit."""
    tails = [c for c in ("p95_error_mw", "p99_error_mw") if c in df.columns]
    return df.withColumns({c: F.round(c, 4) for c in tails})


def baselines(spark: SparkSession, sf: str) -> DataFrame:
    """Validation part of the training frame with both baseline columns present."""
    frame = train_rows(
        spark, sf, required=["consommation_lag_24h", "consommation_lag_168h"]
    )
    split = training.time_split(stage(frame), "date_heure")
    return split.filter(F.col("split") == "val")


# --- sources -------------------------------------------------------------------------


def record_pages(spark: SparkSession, sf: str, drop_zone: bool = False) -> DataFrame:
    """The records as landed JSON pages of up to 100, times written with a +02:00 zone."""
    wall = F.date_format(
        cal.local_time(F.col("_ingested_at"), "Etc/GMT-2"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    )
    zone = F.lit("+02:00")
    if drop_zone:
        zone = F.when(F.col("event_id") % 701 == 0, F.lit("")).otherwise(zone)
    record = F.struct(
        F.concat(wall, zone).alias("date_heure"),
        F.col("region").alias("libelle_region"),
        "consommation",
    )
    return (
        b.consumption(spark, sf)
        .groupBy(F.floor(F.col("event_id") / 100).alias("page"))
        .agg(F.to_json(F.struct(F.collect_list(record).alias("results"))).alias("body"))
    )


def hourly_pages(spark: SparkSession, sf: str, cut_array: bool = False) -> DataFrame:
    """Hourly means as landed documents of parallel arrays, one per key and day."""
    rows = hourly(spark, sf).select(
        "region",
        F.to_date("hour_dt").alias("day"),
        F.struct(
            F.date_format("hour_dt", "yyyy-MM-dd'T'HH:mm").alias("time"),
            F.col("temperature_celsius").alias("temperature_2m"),
            F.col("wind_speed_kmh").alias("wind_speed_10m"),
            F.col("solar_radiation_wm2").alias("direct_radiation"),
        ).alias("r"),
    )
    names = ["time", "temperature_2m", "wind_speed_10m", "direct_radiation"]
    docs = rows.groupBy("region", "day").agg(F.array_sort(F.collect_list("r")).alias("rs"))
    arrays = {n: F.col(f"rs.{n}") for n in names}
    if cut_array:
        short = F.slice(arrays["temperature_2m"], 1, F.size("rs") - 1)
        arrays["temperature_2m"] = F.when(F.dayofmonth("day") % 5 == 0, short).otherwise(
            arrays["temperature_2m"]
        )
    hours = F.struct(*[column.alias(n) for n, column in arrays.items()]).alias("hourly")
    return docs.select("region", "day", F.to_json(F.struct("region", hours)).alias("body"))


@query
def read_records(spark, sf):
    pages = landed.parse_record_pages(record_pages(spark, sf), "body")
    records = validate.validate(
        landed.explode_records(pages), validate.record_rules(), policy="drop"
    )
    return landed.normalise_records(
        records, HOURLY, F.lit(AS_OF).cast("timestamp"), since="2024-01-02T00:00:00"
    )


@query
def read_hourly_arrays(spark, sf):
    pages = landed.parse_hourly_pages(hourly_pages(spark, sf), "body")
    return landed.explode_hourly(
        pages, HOURLY, F.lit(AS_OF).cast("timestamp"), since="2024-01-02T00:00:00"
    )


@query
def region_dim(spark, sf):
    return dimensions.category_index(b.keys(spark, sf), "region")


def order_bounds(spark, sf):
    return b.table(spark, sf, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("start_date"),
        F.to_date(F.max("o_orderdate")).alias("end_date"),
    )


@query
def plan_periods_month(spark, sf):
    return periods.plan_periods(order_bounds(spark, sf), "month")


@query
def plan_periods_year(spark, sf):
    return periods.plan_periods(order_bounds(spark, sf), "year")


@query
def read_backfill(spark, sf):
    start, end = "2024-01-01T06:00:00", "2024-01-30T12:00:00"
    return landed.read_backfill(
        b.consumption(spark, sf, since=start, until=end), HOURLY, start, end, b.keys(spark, sf)
    )


@query
def prefer_source(spark, sf):
    raw = b.consumption(spark, sf)
    consolidated = raw.filter(F.col("event_id") % 2 == 0)
    realtime = raw.filter(F.col("event_id") % 2 == 1)
    return incremental.prefer_source([consolidated, realtime], HOURLY, TIE)


@query
def exogenous_source(spark, sf):
    day = F.to_date("date_heure")
    feed = incremental.exogenous_source(day, F.lit("2024-01-31").cast("date"))
    return eco(spark, sf).groupBy(day.alias("day"), feed.alias("feed")).agg(
        F.count("*").alias("n")
    )


@query
def high_water_mark(spark, sf):
    return incremental.high_water_mark(b.consumption(spark, sf), "date_heure")


@query
def since_with_overlap(spark, sf):
    raw = b.consumption(spark, sf)
    marks = raw.groupBy("region").agg(F.max("date_heure").alias("hwm"))
    filled = incremental.since_with_overlap(marks, AS_OF).withColumn("case", F.lit("filled"))
    empty = raw.filter(F.col("date_heure") > F.lit("2030-01-01").cast("timestamp"))
    fresh = incremental.since_with_overlap(
        incremental.high_water_mark(empty, "date_heure"), AS_OF
    ).withColumn("case", F.lit("empty"))
    return filled.unionByName(fresh)


@query
def refresh_window(spark, sf):
    start = b.hour_text(AS_OF, -incremental.REFRESH_HOURS)
    raw = b.consumption(spark, sf, since=start, until=AS_OF)
    return incremental.refresh_window(raw, HOURLY, AS_OF)


# --- cleaning ------------------------------------------------------------------------


@query
def dedupe_latest(spark, sf):
    return eco(spark, sf)


@query
def dedupe_latest_non_null(spark, sf):
    value = F.when(F.col("event_id") % 3 != 0, F.col("consommation"))
    raw = b.consumption(spark, sf).withColumn("consommation", value)
    return clean.dedupe_latest(raw, HOURLY, TIE, drop_null_value=True)


@query
def time_range(spark, sf):
    start, end = "2024-01-03T00:00:00", "2024-01-28T00:00:00"
    raw = b.consumption(spark, sf, since=start, until=end)
    return clean.time_range(raw, "date_heure", start, end, end_open=True)


@query
def complete_slots(spark, sf):
    return clean.complete_slots(
        eco(spark, sf).select("date_heure", "region", "consommation"), HOURLY, N_KEYS
    )


@query
def null_gate(spark, sf):
    rows = features.pit_lag(eco(spark, sf).select("date_heure", "region", "consommation"), HOURLY)
    return clean.null_gate(rows, ["consommation_lag_24h", "consommation_lag_168h"])


# --- features ------------------------------------------------------------------------


def slots_of(spark, sf):
    return eco(spark, sf).select("date_heure", "region", "consommation")


@query
def pit_lag(spark, sf):
    return features.pit_lag(slots_of(spark, sf), HOURLY)


@query
def pit_lag_join(spark, sf):
    return features.pit_lag_join(slots_of(spark, sf), HOURLY)


@query
def pit_lag_many_keys(spark, sf):
    raw = b.consumption(spark, sf, key="user_id")
    series = clean.dedupe_latest(raw, USERS, TIE).select("date_heure", "user_id", "consommation")
    return features.history_features(series, USERS)


@query
def rolling_mean(spark, sf):
    return features.rolling_mean(slots_of(spark, sf), HOURLY)


@query
def hourly_mean(spark, sf):
    return hourly(spark, sf)


@query
def join_hourly(spark, sf):
    return features.join_hourly(slots_of(spark, sf), hourly(spark, sf), HOURLY)


@query
def calendar_parts(spark, sf):
    rows = cal.calendar(slots_of(spark, sf), "date_heure", "Europe/Paris")
    return rows.drop("is_weekend", "is_public_holiday_fr")


@query
def is_weekend(spark, sf):
    rows = cal.calendar(b.daily(spark, sf), "date_heure", "Europe/Paris")
    return rows.select("date_heure", "region", "is_weekend")


@query
def holiday_flag(spark, sf):
    rows = cal.calendar(b.daily(spark, sf), "date_heure", "Europe/Paris")
    return rows.select("date_heure", "region", "is_public_holiday_fr")


@query
def build_features(spark, sf):
    return feature_rows(spark, sf)


@query
def build_features_since(spark, sf):
    since = "2024-01-12T03:00:00"
    start = b.hour_text(since, -features.ROLLING_HOURS)
    return feature_job.build_features(
        b.consumption(spark, sf, since=start), b.weather(spark, sf, since=since), HOURLY,
        since=since, tiebreak=TIE,
    )


@query
def daily_history_features(spark, sf):
    return features.history_features(
        b.daily(spark, sf).select("date_heure", "region", "consommation"), DAILY
    )


# --- forecast frame ------------------------------------------------------------------


@query
def horizon_slots(spark, sf):
    days = (
        b.table(spark, sf, "orders")
        .select(F.to_date("o_orderdate").alias("forecast_date"))
        .distinct()
    )
    return horizon.horizon_slots(days, Grid())


@query
def scaffold(spark, sf):
    return horizon.scaffold(b.keys(spark, sf), *event_days(spark, sf), HOURLY)


@query
def aligned_lags(spark, sf):
    slots = horizon.scaffold(b.keys(spark, sf), *event_days(spark, sf), HOURLY)
    return horizon.aligned_lags(slots, eco(spark, sf), HOURLY)


@query
def lag_fallback(spark, sf):
    slots = horizon.scaffold(
        b.daily_keys(spark, sf), *order_days(spark, sf), DAILY_UTC, anchor_hour=0
    )
    rows = horizon.aligned_lags(slots, b.daily(spark, sf), DAILY_UTC)
    return horizon.lag_fallback(rows, DAILY_UTC).drop("anchor")


@query
def lag_fallback_count(spark, sf):
    slots = horizon.scaffold(
        b.daily_keys(spark, sf), *order_days(spark, sf), DAILY_UTC, anchor_hour=0
    )
    rows = horizon.aligned_lags(slots, b.daily(spark, sf), DAILY_UTC, lags=(24, 48))
    return horizon.fallback_count(horizon.lag_fallback(rows, DAILY_UTC))


@query
def aligned_rolling(spark, sf):
    slots = horizon.scaffold(b.keys(spark, sf), *event_days(spark, sf), HOURLY)
    return horizon.aligned_rolling(slots, eco(spark, sf), HOURLY).drop("anchor")


@query
def forecast_frame(spark, sf):
    return frame_rows(spark, sf)


@query
def forecast_frame_as_known(spark, sf):
    """Records arrive 30 h late; each day is forecast with what had arrived by its anchor."""
    late = F.col("_ingested_at") + F.expr("INTERVAL 30 HOUR")
    return forecast_job.forecast_frame(
        b.consumption(spark, sf).withColumn("_ingested_at", late), hourly(spark, sf),
        b.keys(spark, sf), *event_days(spark, sf), HOURLY, as_known=True, tiebreak=TIE,
    )


@query
def naive_forecast(spark, sf):
    return predictions(spark, sf)


# --- training ------------------------------------------------------------------------


@query
def training_frame(spark, sf):
    return train_rows(spark, sf)


@query
def training_frame_reference(spark, sf):
    return train_rows(spark, sf, exog_at="reference")


@query
def training_frame_asof(spark, sf):
    return train_rows(spark, sf, exog_at="reference", cutoff="2024-01-25T01:00:00")


@query
def time_split(spark, sf):
    return training.time_split(stage(train_rows(spark, sf)), "date_heure").select(
        "date_heure", "region", "consommation", "split"
    )


@query
def encode(spark, sf):
    return training.encode(feature_rows(spark, sf), LABELS[:4], "region").select(
        "date_heure", "region", "region_idx", "is_weekend", "is_public_holiday_fr"
    )


@query
def min_rows_gate(spark, sf):
    return training.min_rows_gate(train_rows(spark, sf), "region")


@query
def eval_metrics(spark, sf):
    return evaluation.eval_metrics(
        baselines(spark, sf), "consommation", "consommation_lag_24h", ["region"], scale=2
    )


@query
def compare_models(spark, sf):
    models = {"lag_24h": "consommation_lag_24h", "lag_168h": "consommation_lag_168h"}
    return evaluation.compare_models(baselines(spark, sf), "consommation", models, scale=2)


@query
def mae_by_key(spark, sf):
    return evaluation.mae_by_key(
        baselines(spark, sf), "consommation", "consommation_lag_24h", "region", scale=2
    )


@query
def prediction_error_sample(spark, sf):
    return evaluation.prediction_error_sample(
        baselines(spark, sf), "consommation", "consommation_lag_24h", ["date_heure", "region"]
    )


@query
def latest_run(spark, sf):
    return training.latest_run(b.table(spark, sf, "orders"), "o_orderkey", "o_orderdate")


@query
def stale_versions(spark, sf):
    return training.stale_versions(b.table(spark, sf, "orders"), "o_custkey", "o_orderdate")


def daily_training(spark, sf):
    series = b.daily(spark, sf)
    lagged = features.history_features(
        series.select("date_heure", "region", "consommation"), DAILY, rolling=None
    ).drop("consommation")
    target = training.shifted_target(series, DAILY)
    return clean.null_gate(
        lagged.join(target, ["date_heure", "region"]), ["consommation_lag_24h", "consommation"]
    )


@query
def walk_forward_folds(spark, sf):
    """Training rows, split and baseline error for each day of the daily series and the one after."""
    first, last = order_days(spark, sf)[0], order_days(spark, sf, later=1)[1]
    return backtest.fold_summary(daily_training(spark, sf), DAILY, first, last, "consommation_lag_24h")


@query
def walk_forward(spark, sf):
    frame = train_rows(spark, sf, exog_at="reference")
    days = event_days(spark, sf)
    folds = backtest.fold_summary(frame, HOURLY, *days, "consommation_lag_24h")
    return backtest.walk_forward_naive(
        eco(spark, sf), hourly(spark, sf), b.keys(spark, sf), HOURLY, *days, folds
    )


# --- quality -------------------------------------------------------------------------


def recent_pairs(spark, sf):
    return quality.match_actuals(
        predictions(spark, sf), b.consumption(spark, sf), HOURLY, AS_OF, tiebreak=TIE
    )


@query
def match_actuals(spark, sf):
    return recent_pairs(spark, sf)


@query
def key_metrics(spark, sf):
    return rounded(quality.key_metrics(recent_pairs(spark, sf), HOURLY))


@query
def national_metrics(spark, sf):
    return rounded(quality.national_metrics(recent_pairs(spark, sf), HOURLY, N_KEYS))


@query
def metrics_snapshot(spark, sf):
    return rounded(
        quality.metrics_snapshot(
            recent_pairs(spark, sf), HOURLY, N_KEYS, F.lit("2024-01-31"), F.lit(AS_OF)
        )
    )


@query
def metrics_backfill(spark, sf):
    return rounded(metrics(spark, sf))


@query
def mae_alert(spark, sf):
    return rounded(quality.mae_alert(metrics(spark, sf), "region", threshold=60.0))


# --- monitoring ----------------------------------------------------------------------


@query
def recent_forecasts(spark, sf):
    return monitor.recent_forecasts(predictions(spark, sf), HOURLY, AS_OF)


@query
def recent_actuals(spark, sf):
    return monitor.recent_actuals(eco(spark, sf), HOURLY, AS_OF, N_KEYS)


def status(spark, sf):
    """Stamps of the tables: features as the job of the next day, 01:50, would write them, and a
    training run at each day's cutoff."""
    written = F.date_add(F.to_date("date_heure"), 1).cast("timestamp") + F.expr("INTERVAL 110 MINUTE")
    keys = b.keys(spark, sf)
    runs = backtest.fold_days(keys, *event_days(spark, sf), HOURLY.tz)
    return monitor.system_status(
        {
            "ingest": (b.consumption(spark, sf), "_ingested_at"),
            "features": (eco(spark, sf).withColumn("_materialized_at", written), "_materialized_at"),
            "train": (runs.withColumn("created_at", F.timestamp_seconds("cutoff")), "created_at"),
            "forecast": (predictions(spark, sf), "forecasted_at"),
            "eval": (metrics(spark, sf), "_computed_at"),
        }
    )


@query
def system_status(spark, sf):
    return status(spark, sf)


@query
def freshness(spark, sf):
    return monitor.freshness(status(spark, sf), AS_OF)


@query
def latest_metrics(spark, sf):
    return rounded(monitor.latest_metrics(stored_metrics(spark, sf), "region"))


@query
def metrics_history(spark, sf):
    return monitor.metrics_history(metrics(spark, sf), "region", "2024-01-31")


@query
def completeness(spark, sf):
    return monitor.completeness(b.consumption(spark, sf), HOURLY, AS_OF, N_KEYS)


@query
def next_slot_total(spark, sf):
    return monitor.next_slot_total(predictions(spark, sf), HOURLY, "2024-01-20T07:30:00")


@query
def latest_batch(spark, sf):
    return monitor.latest_batch(predictions(spark, sf))


@query
def latest_batch_daily(spark, sf):
    runs = b.table(spark, sf, "orders").select(
        F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("model_version"),
        F.col("o_orderdate").cast("timestamp").alias("forecasted_at"),
    )
    return monitor.latest_batch(runs)


@query
def mean_by_key(spark, sf):
    return monitor.mean_by_key(predictions(spark, sf), HOURLY)


@query
def day_view(spark, sf):
    return monitor.day_view(
        predictions(spark, sf), eco(spark, sf), HOURLY, "2024-01-29T12:00:00"
    )


@query
def day_view_key(spark, sf):
    return monitor.day_view(
        predictions(spark, sf), eco(spark, sf), HOURLY, "2024-01-29T12:00:00", key="click"
    )


@query
def mae_ranking(spark, sf):
    return monitor.mae_ranking(stored_metrics(spark, sf), "region")


@query
def hour_heatmap(spark, sf):
    table = monitor.hour_heatmap(predictions(spark, sf), HOURLY)
    return table.withColumn("row_total", F.round("row_total", 4)).drop("label")


@query
def kpi_strip(spark, sf):
    return rounded(
        monitor.kpi_strip(
            stored_metrics(spark, sf), predictions(spark, sf), b.consumption(spark, sf), HOURLY,
            "2024-01-30T12:00:00", N_KEYS,
        )
    )


@query
def prediction_audit(spark, sf):
    return monitor.prediction_audit(predictions(spark, sf), "2024-01-01T00:00:00")


@query
def smoke_checks(spark, sf):
    return monitor.smoke_checks(
        b.consumption(spark, sf), predictions(spark, sf), HOURLY, AS_OF
    )


# --- validation ----------------------------------------------------------------------


@query
def validate_records(spark, sf):
    """Records without a zone, by reason, among all landed records."""
    pages = landed.parse_record_pages(record_pages(spark, sf, drop_zone=True), "body")
    good, bad = validate.quarantine(landed.explode_records(pages), validate.record_rules())
    kept = good.select(F.col("libelle_region").alias("region"), F.lit("good").alias("reason"))
    refused = bad.select(
        F.col("libelle_region").alias("region"), F.array_join("_reason", ",").alias("reason")
    )
    return kept.unionByName(refused).groupBy("region", "reason").agg(F.count("*").alias("n"))


@query
def validate_pages(spark, sf):
    """Whole pages refused for one bad record."""
    raw = record_pages(spark, sf, drop_zone=True)
    pages = raw.select("page", F.from_json("body", landed.RECORD_PAGE).alias("p")).select(
        "page", "p.*"
    )
    good, bad = validate.quarantine(pages, validate.record_page_rules())
    kept = good.select("page", F.lit("good").alias("reason"))
    return kept.unionByName(bad.select("page", F.array_join("_reason", ",").alias("reason")))


@query
def validate_hourly(spark, sf):
    docs = hourly_pages(spark, sf, cut_array=True)
    pages = docs.select("day", F.from_json("body", landed.HOURLY_PAGE).alias("p")).select(
        "day", "p.*"
    )
    good, bad = validate.quarantine(pages, validate.hourly_page_rules())
    kept = good.select("region", "day", F.lit("good").alias("reason"))
    return kept.unionByName(
        bad.select("region", "day", F.array_join("_reason", ",").alias("reason"))
    )


def dubious_predictions(spark, sf):
    """Predictions with values broken by position: zero, negative, NaN, infinite."""
    h = F.dayofmonth("forecast_horizon_dt") % 7
    value = (
        F.when(h == 1, F.lit(0.0))
        .when(h == 2, -F.col("predicted_mw"))
        .when(h == 3, F.lit(float("nan")))
        .when(h == 4, F.lit(float("inf")))
        .otherwise(F.col("predicted_mw"))
    )
    return predictions(spark, sf).withColumn("predicted_mw", value)


@query
def validate_predictions(spark, sf):
    rules = validate.prediction_rules("region", LABELS[:4])
    good, bad = validate.quarantine(dubious_predictions(spark, sf), rules)
    columns = ["forecast_horizon_dt", "region"]
    kept = good.select(*columns, F.lit("good").alias("reason"))
    return kept.unionByName(bad.select(*columns, F.array_join("_reason", ",").alias("reason")))


@query
def validate_metrics(spark, sf):
    mae = F.when(F.col("n_samples") % 2 == 0, F.col("mae_mw")).otherwise(F.lit(float("nan")))
    rows = metrics(spark, sf).withColumn("mae_mw", mae)
    return rounded(validate.validate(rows, validate.metrics_rules(), policy="drop"))


@query
def violations(spark, sf):
    return validate.violations(
        dubious_predictions(spark, sf), validate.prediction_rules("region", LABELS[:4])
    )


# --- tables --------------------------------------------------------------------------


@query
def upsert_rows(spark, sf):
    rows = eco(spark, sf)
    day = F.dayofmonth("date_heure")
    old = rows.filter(day <= 20)
    new = rows.filter(day >= 15).withColumn("consommation", F.col("consommation") + 1)
    return tables.upsert_rows(old, new, ["date_heure", "region"])


@query
def expire(spark, sf):
    return tables.expire(b.daily(spark, sf), "date_heure", DAILY_AS_OF, 730).select(
        "date_heure", "region", "consommation"
    )


@query
def expired_days(spark, sf):
    return tables.expired_days(b.daily(spark, sf), "date_heure", DAILY_AS_OF, 730)


# --- tables written and read back --------------------------------------------------------


def new_store(spark) -> Store:
    return Store(spark, shared_folder(spark))


@query
def append_table(spark, sf):
    store, raw = new_store(spark), b.consumption(spark, sf)
    early = F.dayofmonth("date_heure") <= 15
    store.append("consumption", raw.filter(early))
    store.append("consumption", raw.filter(~early))
    return store.read("consumption")


@query
def upsert_table(spark, sf):
    store, rows = new_store(spark), eco(spark, sf)
    day = F.dayofmonth("date_heure")
    store.upsert("consumption", rows.filter(day <= 20))
    changed = rows.filter(day >= 15).withColumn("consommation", F.col("consommation") + 1)
    store.upsert("consumption", changed)
    store.upsert("consumption", changed)
    return store.read("consumption")


@query
def table_layout(spark, sf):
    """Rows per day folder as written; the folder name is the partition value."""
    store = new_store(spark)
    store.append("consumption", b.consumption(spark, sf))
    files = spark.read.parquet(store.path("consumption"))
    return files.groupBy("day").agg(
        F.count("*").alias("n_rows"), F.count_distinct("region").alias("n_regions")
    )


@query
def drop_expired(spark, sf):
    """Day folders past a 10-day limit are deleted; the others keep their files."""
    store = new_store(spark)
    store.append("consumption", b.consumption(spark, sf))
    layout = replace(store.layout("consumption"), retention_days=10)
    tables.drop_expired(spark, store.path("consumption"), layout, AS_OF)
    return store.read("consumption")


@query
def truncate_tables(spark, sf):
    store = new_store(spark)
    store.append("consumption", b.consumption(spark, sf))
    before = store.read("consumption").count()
    store.truncate()
    return store.read("consumption").agg(F.count("*").alias("n_after")).withColumn(
        "n_before", F.lit(before).cast("long")
    )


@query
def materialize_incremental(spark, sf):
    """First run on 20 days, a second one after the rest arrived; equals one full run."""
    store = new_store(spark)
    early = F.col("_ingested_at") < F.lit("2024-01-21").cast("timestamp")
    raw, readings = b.consumption(spark, sf), b.weather(spark, sf)
    store.append("consumption", raw.filter(early))
    store.append("weather", readings.filter(early))
    feature_job.materialize_incremental(
        store, HOURLY, "2024-01-20T23:59:59.999999", since="2023-12-31T00:00:00"
    )
    store.append("consumption", raw.filter(~early))
    store.append("weather", readings.filter(~early))
    feature_job.materialize_incremental(store, HOURLY, AS_OF)
    return store.read("features").drop("_materialized_at")


@query
def materialize_incremental_late(spark, sf):
    """Records stamped before the first run and committed after it, up to 20 days back."""
    store = new_store(spark)
    early = F.col("_ingested_at") < F.lit("2024-01-21").cast("timestamp")
    first = early & (F.col("event_id") % 97 != 0)
    raw, readings = b.consumption(spark, sf), b.weather(spark, sf)
    store.append("consumption", raw.filter(first))
    store.append("weather", readings)
    feature_job.materialize_incremental(
        store, HOURLY, "2024-01-21T02:00:00", since="2023-12-31T00:00:00"
    )
    store.append("consumption", raw.filter(~first))
    feature_job.materialize_incremental(store, HOURLY, AS_OF)
    return store.read("features").drop("_materialized_at")


@query
def run_ingest(spark, sf):
    """A first run on part of the landed pages, then one on all of them."""
    store = new_store(spark)
    stamp = "2023-12-25T00:00:00"
    pages, docs = record_pages(spark, sf), hourly_pages(spark, sf)
    ingest_job.run_ingest(
        store, HOURLY, pages.filter("page % 2 = 0"), docs.filter("day < '2024-01-11'"), stamp
    )
    late = ingest_job.start_of(store, "weather", HOURLY, stamp)
    ingest_job.run_ingest(store, HOURLY, pages, docs, "2024-01-31T00:00:00")
    slots = store.read("consumption").select(
        "date_heure", "region", "consommation", F.lit("consumption").alias("table_name")
    )
    hours = store.read("weather").select(
        "date_heure", "region", F.col("wind_speed_kmh").alias("consommation"),
        F.concat(F.lit("weather since "), F.lit(late[:19])).alias("table_name"),
    )
    return slots.unionByName(hours)


@query
def run_reingest(spark, sf):
    """All rows but for the corrections of the last 168 h, then those."""
    store, raw = new_store(spark), b.consumption(spark, sf)
    ingest_job.load(store, "consumption", eco(spark, sf).drop("event_id"), HOURLY)
    corrected = raw.drop("event_id").withColumn("consommation", F.col("consommation") + 1).withColumn(
        "_ingested_at", F.col("_ingested_at") + F.expr("INTERVAL 1 DAY")
    )
    ingest_job.run_reingest(store, HOURLY, corrected, AS_OF)
    return store.read("consumption").select("date_heure", "region", "consommation")


@query
def run_backfill(spark, sf):
    store = new_store(spark)
    ingest_job.run_backfill(
        store, HOURLY, b.consumption(spark, sf).drop("event_id"),
        "2024-01-05T00:00:00", "2024-01-25T00:00:00", b.keys(spark, sf),
    )
    return store.read("consumption")


@query
def quarantined_pages(spark, sf):
    """Pages set aside by reason: records without a zone, without results, malformed text."""
    body = (
        F.when(F.col("page") % 11 == 3, F.lit('{"error": "quota"}'))
        .when(F.col("page") % 11 == 5, F.substring("body", 1, 40))
        .otherwise(F.col("body"))
    )
    pages = record_pages(spark, sf, drop_zone=True).withColumn("body", body)
    good, refused = ingest_job.record_pages(pages, "body", "quarantine")
    kept = good.select(F.lit("good").alias("reason"))
    reason = F.when(F.array_contains("_reason", "well_formed"), "well_formed").otherwise(
        F.get("_reason", F.lit(0))
    )
    return kept.unionByName(refused.select(reason.alias("reason"))).groupBy("reason").agg(
        F.count("*").alias("n")
    )


@query
def write_predictions(spark, sf):
    """One day forecast from stored tables, validated and upserted."""
    store = new_store(spark)
    store.append("consumption", b.consumption(spark, sf))
    store.append("weather", b.weather(spark, sf))
    fallback = F.coalesce("consommation_lag_24h", "consommation_rolling_168h")
    forecast_job.run_forecast(
        store, HOURLY, "2024-01-29", LABELS,
        lambda frame: frame.withColumn("predicted_mw", fallback + 1),
        "naive24", "2024-01-29T05:00:00",
    )
    return store.read("predictions")


@query
def run_metrics(spark, sf):
    store = new_store(spark)
    store.append("consumption", b.consumption(spark, sf))
    store.append("predictions", predictions(spark, sf))
    metrics_job.run_metrics(store, HOURLY, AS_OF, N_KEYS)
    metrics_job.run_metrics(store, HOURLY, AS_OF, N_KEYS)
    return rounded(store.read("metrics"))


# --- streaming -----------------------------------------------------------------------------


def landing(spark, df, files: int = 6) -> tuple[str, str]:
    """The rows as landed files, and a checkpoint folder next to them."""
    root = shared_folder(spark)
    df.repartitionByRange(files, "_ingested_at").write.parquet(f"{root}/landed")
    return f"{root}/landed", f"{root}/checkpoint"


@query
def stream_upsert(spark, sf):
    path, checkpoint = landing(spark, b.consumption(spark, sf).drop("event_id"))
    store = new_store(spark)
    source = jobs.read_landed(spark, path, CONSUMPTION, files_per_trigger=2)
    jobs.run_to_end(jobs.stream_upsert(source, store, "consumption", HOURLY, checkpoint))
    return store.read("consumption")


@query
def stream_hourly(spark, sf):
    """Hours closed by a watermark of 6 h at the end of the input."""
    path, checkpoint = landing(spark, b.weather(spark, sf))
    source = jobs.read_landed(spark, path, WEATHER)
    out = f"{checkpoint}-out"
    jobs.run_to_end(jobs.write_files(jobs.stream_hourly(source, HOURLY), out, checkpoint))
    return spark.read.parquet(out)


@query
def stream_dedupe(spark, sf):
    """Every record delivered twice; repeats within the watermark are dropped."""
    raw = b.consumption(spark, sf)
    path, checkpoint = landing(spark, raw.unionByName(raw))
    schema = raw.schema
    source = jobs.read_landed(spark, path, schema)
    out = f"{checkpoint}-out"
    once = jobs.stream_dedupe(source, "_ingested_at", ["event_id"])
    jobs.run_to_end(jobs.write_files(once, out, checkpoint))
    return spark.read.schema(schema).parquet(out)


@query
def stream_metrics(spark, sf):
    path, checkpoint = landing(spark, b.consumption(spark, sf).drop("event_id"))
    store = new_store(spark)
    store.append("predictions", predictions(spark, sf))
    source = jobs.read_landed(spark, path, CONSUMPTION, files_per_trigger=3)
    jobs.run_to_end(jobs.stream_metrics(source, store, HOURLY, AS_OF, N_KEYS, checkpoint))
    return rounded(store.read("metrics"))


# --- learners: checked for rows; trees have no SQL form -------------------------------------


def fitted(spark, sf, fit=learners.fit_gbt):
    split = training.time_split(stage(train_rows(spark, sf)), "date_heure")
    train, val = (split.filter(F.col("split") == s).drop("split") for s in ("train", "val"))
    model, best = fit(train, val, LABELS)
    return model, best, val


@query
def fit_gbt(spark, sf):
    model, best, val = fitted(spark, sf)
    return learners.validation_metrics(model, val, "consommation").withColumn(
        "best_round", F.lit(best)
    )


@query
def fit_alt_learner(spark, sf):
    model, best, val = fitted(spark, sf, learners.fit_alt_learner)
    return learners.validation_metrics(model, val, "consommation").withColumn(
        "best_round", F.lit(best)
    )


@query
def score(spark, sf):
    model, _, _ = fitted(spark, sf)
    return learners.score(model, frame_rows(spark, sf)).select(
        "forecast_horizon_dt", "region", "forecast_date", "predicted_mw"
    )


@query
def feature_importance(spark, sf):
    model, _, _ = fitted(spark, sf)
    return spark.createDataFrame(learners.feature_importance(model), "feature string, gain double")


@query
def permutation_importance(spark, sf):
    model, _, val = fitted(spark, sf)
    return learners.permutation_importance(model, val, ["date_heure", "region"], fraction=1.0)


@query
def permutation_importance_alt(spark, sf):
    model, _, val = fitted(spark, sf, learners.fit_alt_learner)
    return learners.permutation_importance(model, val, ["date_heure", "region"], fraction=1.0)


def scored_by_both(spark, sf) -> DataFrame:
    """Validation rows with both lags, and with the predictions of both learners."""
    frame = train_rows(spark, sf, required=["consommation_lag_24h", "consommation_lag_168h"])
    split = training.time_split(stage(frame), "date_heure")
    train, val = (split.filter(F.col("split") == s).drop("split") for s in ("train", "val"))
    out = val
    for name, fit in {"gbt": learners.fit_gbt, "alt": learners.fit_alt_learner}.items():
        model, _ = fit(train, val, LABELS)
        out = learners.score(model, out).withColumnRenamed("predicted_mw", name)
    return out


@query
def compare_learners(spark, sf):
    """Both learners and both lags on the same validation rows."""
    models = {"gbt": "gbt", "alt": "alt", "lag_24h": "consommation_lag_24h", "lag_168h": "consommation_lag_168h"}
    return evaluation.compare_models(stage(scored_by_both(spark, sf)), "consommation", models)


@query
def learned_error_sample(spark, sf):
    return evaluation.prediction_error_sample(scored_by_both(spark, sf), "consommation", "gbt", ["date_heure", "region"])


@query
def run_log(spark, sf):
    root = shared_folder(spark)
    training_job.train(train_rows(spark, sf), HOURLY, LABELS, root, AS_OF)
    return training_job.read_runs(spark, f"{root}/runs")


def walked(spark, sf) -> Store:
    """A learned walk-forward over every day of the table, in a store of its own."""
    store, days = new_store(spark), event_days(spark, sf)
    frame = stage(train_rows(spark, sf, as_of=f"{days[0]}T00:00:00"))
    keys = b.keys(spark, sf)
    walk_forward_plan.walk_forward(store, frame, frame_rows(spark, sf), keys, HOURLY, LABELS, *days, name="walk")
    return store


@query
def walk_forward_gbt(spark, sf):
    """A refit for every day of the table; each forecasts the day it was fitted for."""
    return walked(spark, sf).read("predictions")


@query
def walk_forward_ledger(spark, sf):
    """Training and validation rows of every fold that was fitted, from the ledger of the runs."""
    ledger = walk_forward_plan.read_ledger(spark, walked(spark, sf).root)
    return ledger.select("forecast_date", "n_train", "n_val", "n_features", "val_fraction")


@query
def run_log_split(spark, sf):
    """Rows of the logged run's two parts."""
    root = shared_folder(spark)
    training_job.train(train_rows(spark, sf), HOURLY, LABELS, root, AS_OF, rounds=1)
    return training_job.read_runs(spark, f"{root}/runs").select("n_train", "n_val", "n_features", "val_fraction")


def rebuilt(spark, sf, **options) -> Store:
    store = new_store(spark)
    raw = b.consumption(spark, sf)
    feeds = [raw.filter(F.col("event_id") % 2 == parity).drop("event_id") for parity in (0, 1)]
    rebuild.full_rebuild(
        store, HOURLY, feeds, b.weather(spark, sf), LABELS, "2023-12-31T00:00:00", AS_OF,
        "2024-01-29", **options,
    )
    return store


@query
def full_rebuild(spark, sf):
    return rebuilt(spark, sf).read("predictions").drop("model_version")


@query
def full_rebuild_counts(spark, sf):
    """Rows of the tables after a rebuild, and the steps that its journal notes."""
    store = rebuilt(spark, sf, rounds=1)
    steps = spark.read.schema(journal.JOURNAL).parquet(f"{store.root}/journal")
    counts = [
        store.read(name).select(F.lit(name).alias("name")).groupBy("name").count()
        for name in ("consumption", "features", "predictions", "weather")
    ]
    out = steps.select(F.lit("journal").alias("name")).groupBy("name").count()
    for part in counts:
        out = out.union(part)
    return out.select("name", F.col("count").alias("n_rows"))
