"""Declared schemas of the five tables, the landed payloads and the run log.

Readers always get one of these; nothing is inferred.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: table contracts (names and types the data must have) -----------

CONSUMPTION = T.StructType(
    [
        T.StructField("date_heure", T.TimestampType(), False),
        T.StructField("region", T.StringType(), False),
        T.StructField("consommation", T.DoubleType()),
        T.StructField("_ingested_at", T.TimestampType(), False),
    ]
)

WEATHER_MEASURES = ["temperature_celsius", "wind_speed_kmh", "solar_radiation_wm2"]

WEATHER = T.StructType(
    [
        T.StructField("date_heure", T.TimestampType(), False),
        T.StructField("region", T.StringType(), False),
        *[T.StructField(name, T.DoubleType()) for name in WEATHER_MEASURES],
        T.StructField("_ingested_at", T.TimestampType(), False),
    ]
)


def _feature(name: str, dtype: T.DataType, source: str, text: str, nullable: bool = True):
    return T.StructField(name, dtype, nullable, {"source": source, "description": text})


FEATURES = T.StructType(
    [
        _feature("date_heure", T.TimestampType(), "consumption", "slot start, UTC", False),
        _feature("region", T.StringType(), "consumption", "series key", False),
        _feature("consommation_lag_24h", T.DoubleType(), "consumption", "value 24 h before"),
        _feature("consommation_lag_48h", T.DoubleType(), "consumption", "value 48 h before"),
        _feature("consommation_lag_168h", T.DoubleType(), "consumption", "value 7 d before"),
        _feature("consommation_rolling_168h", T.DoubleType(), "consumption", "mean of the 7 d before"),
        _feature("temperature_celsius", T.DoubleType(), "weather", "mean over the hour"),
        _feature("wind_speed_kmh", T.DoubleType(), "weather", "mean over the hour"),
        _feature("solar_radiation_wm2", T.DoubleType(), "weather", "mean over the hour"),
        _feature("hour_of_day", T.IntegerType(), "derived", "local hour, 0 to 23"),
        _feature("day_of_week", T.IntegerType(), "derived", "local weekday, 0 = Monday"),
        _feature("month", T.IntegerType(), "derived", "local month, 1 to 12"),
        _feature("is_weekend", T.BooleanType(), "derived", "Saturday or Sunday"),
        _feature("is_public_holiday_fr", T.BooleanType(), "derived", "French public holiday"),
        _feature("_materialized_at", T.TimestampType(), "job", "time of computation", False),
    ]
)

PREDICTIONS = T.StructType(
    [
        T.StructField("forecast_horizon_dt", T.TimestampType(), False),
        T.StructField("region", T.StringType(), False),
        T.StructField("predicted_mw", T.DoubleType(), False),
        T.StructField("model_version", T.StringType()),
        T.StructField("forecast_date", T.DateType(), False),
        T.StructField("forecasted_at", T.TimestampType(), False),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("computed_date", T.DateType(), False),
        T.StructField("region", T.StringType(), False),
        T.StructField("mae_mw", T.DoubleType()),
        T.StructField("p95_error_mw", T.DoubleType()),
        T.StructField("p99_error_mw", T.DoubleType()),
        T.StructField("n_samples", T.LongType()),
        T.StructField("_computed_at", T.TimestampType(), False),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("created_at", T.TimestampType(), False),
        T.StructField("n_train", T.LongType()),
        T.StructField("n_val", T.LongType()),
        T.StructField("val_fraction", T.DoubleType()),
        T.StructField("features", T.ArrayType(T.StringType())),
        T.StructField("n_features", T.IntegerType()),
        T.StructField("best_iteration", T.IntegerType()),
        T.StructField("val_mae_mw", T.DoubleType()),
        T.StructField("val_rmse_mw", T.DoubleType()),
        T.StructField("artifact", T.StringType()),
    ]
)

# Landed payloads, one JSON document per page.
RECORD_PAGE = T.StructType(
    [
        T.StructField(
            "results",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("date_heure", T.StringType()),
                        T.StructField("libelle_region", T.StringType()),
                        T.StructField("consommation", T.DoubleType()),
                    ]
                )
            ),
        )
    ]
)

# Payload array name -> table column.
HOURLY_ARRAYS = {
    "temperature_2m": "temperature_celsius",
    "wind_speed_10m": "wind_speed_kmh",
    "direct_radiation": "solar_radiation_wm2",
}

HOURLY_PAGE = T.StructType(
    [
        T.StructField("region", T.StringType()),
        T.StructField(
            "hourly",
            T.StructType(
                [T.StructField("time", T.ArrayType(T.StringType()))]
                + [T.StructField(name, T.ArrayType(T.DoubleType())) for name in HOURLY_ARRAYS]
            ),
        ),
    ]
)

# Model inputs in the order the assembler sees them.
MODEL_FEATURES = [
    "region",
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

# --- end of fixed values -------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """How a table lies on disk: day partition, clustering key, upsert key, retention."""

    schema: T.StructType
    time: str
    key: str
    upsert_keys: tuple[str, ...]
    retention_days: int | None
    day: str = "day"

    @property
    def partition_is_column(self) -> bool:
        """The partition day is itself a declared date column."""
        return self.time == self.day


TABLES = {
    "consumption": Layout(CONSUMPTION, "date_heure", "region", ("date_heure", "region"), 730),
    "weather": Layout(WEATHER, "date_heure", "region", ("date_heure", "region"), 730),
    "features": Layout(FEATURES, "date_heure", "region", ("date_heure", "region"), 90),
    "predictions": Layout(
        PREDICTIONS, "forecast_horizon_dt", "region", ("forecast_horizon_dt", "region"), 90
    ),
    "metrics": Layout(
        METRICS, "computed_date", "region", ("computed_date", "region"), None, "computed_date"
    ),
}
