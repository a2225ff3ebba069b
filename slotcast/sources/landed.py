"""Landed API pages to rows.

Pages arrive as JSON files or as a string column; both become one struct per page and
are exploded by Spark.  A page without records or with unequal arrays fails the read, as
one bad record fails its page upstream; ``plans.ingest_job`` can set such pages aside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import nan_to_null
from ..functions.timegrid import instant
from ..grid import Grid
from ..schemas import HOURLY_ARRAYS, HOURLY_PAGE, RECORD_PAGE

# Fixed value: a time string must end in a zone.
ZONED = r"(Z|[+-]\d{2}:?\d{2})$"
MALFORMED = "_malformed"


def read_record_pages(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Record pages from JSON files, one document per file."""
    return spark.read.schema(RECORD_PAGE).json(paths, multiLine=True, mode="FAILFAST")


def _parsed(df: DataFrame, column: str, schema: T.StructType, keep_malformed: bool) -> DataFrame:
    """Pages from a string column: malformed text fails, or is kept in ``_malformed``."""
    options = {"mode": "FAILFAST"}
    if keep_malformed:
        schema = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    page = F.from_json(column, schema, options)
    return df.select(page.alias("_page")).select("_page.*")


def parse_record_pages(df: DataFrame, column: str, keep_malformed: bool = False) -> DataFrame:
    """Record pages from a string column."""
    return _parsed(df, column, RECORD_PAGE, keep_malformed)


def explode_records(pages: DataFrame) -> DataFrame:
    """One row per record, still as landed (time is text).

    A page without ``results`` fails the read: it is an error answer, not an empty page.
    """
    absent = F.raise_error(F.lit("a page has no results"))
    return pages.select(
        F.inline(F.coalesce("results", F.when(F.col("results").isNull(), absent).cast(RECORD_PAGE["results"].dataType)))
    )


def normalise_records(
    records: DataFrame, grid: Grid, ingested_at: Column, since: str | None = None
) -> DataFrame:
    """UTC times, contract names, values present and later than ``since``."""
    rows = records.select(
        F.to_timestamp("date_heure").alias(grid.time),
        F.col("libelle_region").alias(grid.key),
        nan_to_null("consommation").alias(grid.value),
        ingested_at.alias(grid.ingested),
    ).filter(F.col(grid.value).isNotNull())
    return rows if since is None else rows.filter(F.col(grid.time) > instant(since))


def read_hourly_pages(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Hourly-array pages from JSON files, one document per file."""
    return spark.read.schema(HOURLY_PAGE).json(paths, multiLine=True, mode="FAILFAST")


def parse_hourly_pages(df: DataFrame, column: str, keep_malformed: bool = False) -> DataFrame:
    """Hourly-array pages from a string column."""
    return _parsed(df, column, HOURLY_PAGE, keep_malformed)


def explode_hourly(
    pages: DataFrame, grid: Grid, ingested_at: Column, since: str | None = None
) -> DataFrame:
    """One row per hour from parallel arrays of equal length.

    Arrays that are missing or of unequal length fail the read, as zipping would pad the
    shorter ones with NULL.
    """
    same = F.size("hourly.time") >= 0
    for name in HOURLY_ARRAYS:
        same = same & (F.size(f"hourly.{name}") == F.size("hourly.time"))
    message = F.lit("a page's hourly arrays are missing or differ in length")
    hourly = F.when(F.coalesce(same, F.lit(False)), F.col("hourly")).otherwise(
        F.raise_error(message).cast(HOURLY_PAGE["hourly"].dataType)
    )
    pages = pages.withColumn("hourly", hourly)
    zipped = F.arrays_zip(
        F.col("hourly.time").alias("time"),
        *[F.col(f"hourly.{name}").alias(name) for name in HOURLY_ARRAYS],
    )
    rows = pages.select("region", F.inline(zipped)).select(
        F.to_timestamp("time").alias(grid.time),
        F.col("region").alias(grid.key),
        *[nan_to_null(name).alias(column) for name, column in HOURLY_ARRAYS.items()],
        ingested_at.alias(grid.ingested),
    )
    return rows if since is None else rows.filter(F.col(grid.time) > instant(since))


def read_backfill(
    df: DataFrame, grid: Grid, start: str, end: str, keys: DataFrame | None = None
) -> DataFrame:
    """Bounded historical read ``[start, end)`` with values present, for given keys.

    All months and keys are one job; the bounds are literals and reach the scan.
    """
    rows = df.filter(
        (F.col(grid.time) >= instant(start))
        & (F.col(grid.time) < instant(end))
        & F.col(grid.value).isNotNull()
    )
    return rows if keys is None else rows.join(keys.select(grid.key), grid.key, "left_semi")
