"""The region dimension and its fixed category order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ranks import ranked

# Code, name, latitude, longitude of the 12 metropolitan regions.
REGIONS = [
    ("11", "Île-de-France", 48.8566, 2.3522),
    ("24", "Centre-Val de Loire", 47.7516, 1.6751),
    ("27", "Bourgogne-Franche-Comté", 47.2805, 4.9994),
    ("28", "Normandie", 49.1829, 0.3707),
    ("32", "Hauts-de-France", 50.4902, 2.7857),
    ("44", "Grand Est", 48.6994, 6.1867),
    ("52", "Pays de la Loire", 47.7624, -0.3296),
    ("53", "Bretagne", 48.2020, -2.9326),
    ("75", "Nouvelle-Aquitaine", 44.8378, 0.5792),
    ("76", "Occitanie", 43.8485, 3.2503),
    ("84", "Auvergne-Rhône-Alpes", 45.7597, 4.8422),
    ("93", "Provence-Alpes-Côte d'Azur", 43.9352, 6.0679),
]

REGION_LABELS = sorted(name for _, name, _, _ in REGIONS)


def region_dim(spark: SparkSession) -> DataFrame:
    """Code, name, coordinates and category index of each region."""
    rows = [(c, n, la, lo, REGION_LABELS.index(n)) for c, n, la, lo in REGIONS]
    return spark.createDataFrame(
        rows, "code string, region string, lat double, lon double, region_idx int"
    )


def category_index(keys: DataFrame, key: str) -> DataFrame:
    """Index of each key in name order, for a dimension that comes from data.

    The input is a key dimension: one row per series, not per observation.
    """
    return ranked(keys.select(key).distinct(), [key], f"{key}_idx").withColumn(f"{key}_idx", F.col(f"{key}_idx").cast("int"))
