"""Whether a folder exists, and its removal, on whatever file system Spark uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def located(spark: SparkSession, path: str):
    """File system and path object of a location."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    files, location = located(spark, path)
    return files.exists(location)


def delete(spark: SparkSession, path: str) -> None:
    files, location = located(spark, path)
    files.delete(location, True)
