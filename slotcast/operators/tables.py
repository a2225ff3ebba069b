"""Parquet tables by day: append, keyed upsert, layout, retention, truncation.

An upsert touches only the days its rows fall on.  It first writes the new contents of
those days next to the table's shared scratch space and then swaps them in with a
dynamic partition overwrite, so no plan overwrites files it is reading, a lost executor
only costs a retried task, and an interrupted swap can be published again.  One writer
per table at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..files import delete, exists, located
from ..functions.timegrid import instant
from ..schemas import Layout
from ..session import shared_folder
from .clean import latest_per


def _stored_schema(layout: Layout) -> T.StructType:
    if layout.partition_is_column:
        return layout.schema
    return T.StructType([*layout.schema.fields, T.StructField(layout.day, T.DateType())])


def conform(df: DataFrame, layout: Layout) -> DataFrame:
    """Declared columns, order and types plus the partition day.

    A NULL in a required column fails the write while it runs, before anything is
    committed; no extra pass over the data.
    """
    missing = [f.name for f in layout.schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    columns = []
    for field in layout.schema.fields:
        column = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            error = F.raise_error(F.lit(f"NULL in required column {field.name}"))
            column = F.when(column.isNull(), error).otherwise(column)
        columns.append(column.cast(field.dataType).alias(field.name))
    return _with_day(df.select(*columns), layout)


def _with_day(df: DataFrame, layout: Layout) -> DataFrame:
    if layout.partition_is_column:
        return df
    return df.withColumn(layout.day, F.to_date(layout.time))


def arrange(df: DataFrame, layout: Layout) -> DataFrame:
    """Rows gathered by day and sorted by key for row-group skipping.

    ``rebalance`` lets adaptive execution split a day that holds too much and merge
    days that hold little, so one hot day never becomes one task.
    """
    return df.hint("rebalance", layout.day).sortWithinPartitions(*_order(layout))


def _order(layout: Layout) -> list[str]:
    return list(dict.fromkeys([layout.day, layout.key, layout.time]))


def read_table(
    spark: SparkSession,
    path: str,
    layout: Layout,
    first_day: str | None = None,
    last_day: str | None = None,
) -> DataFrame:
    """The table with its declared schema; days outside the bounds are never opened."""
    schema = _stored_schema(layout)
    if not exists(spark, path):
        return spark.createDataFrame([], layout.schema)
    df = spark.read.schema(schema).parquet(path)
    if first_day is not None:
        df = df.filter(F.col(layout.day) >= F.lit(first_day).cast("date"))
    if last_day is not None:
        df = df.filter(F.col(layout.day) <= F.lit(last_day).cast("date"))
    return df.select(*layout.schema.fieldNames())


def read_days(spark: SparkSession, path: str, layout: Layout, days: Sequence) -> DataFrame:
    """The given days only; the other folders of the table are not even listed."""
    folders = [f"{path}/{layout.day}={day}" for day in days]
    folders = [folder for folder in folders if exists(spark, folder)]
    if not folders:
        return spark.createDataFrame([], layout.schema)
    stored = spark.read.schema(_stored_schema(layout)).option("basePath", path)
    return stored.parquet(*folders).select(*layout.schema.fieldNames())


def last_day(spark: SparkSession, path: str, layout: Layout) -> str | None:
    """The newest day folder; no file is opened."""
    if not exists(spark, path):
        return None
    files, location = located(spark, path)
    names = [status.getPath().getName() for status in files.listStatus(location)]
    prefix = f"{layout.day}="
    return max((n.removeprefix(prefix) for n in names if n.startswith(prefix)), default=None)


def day_files(spark: SparkSession, path: str, layout: Layout) -> DataFrame:
    """(day, files): a digest of the file names of each day; file contents are not read.

    Every write gives new names, so a day whose digest has changed was written since, whatever
    the stamps of its rows.
    """
    if last_day(spark, path, layout) is None:
        return spark.createDataFrame([], "day string, files string")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return listed.groupBy(F.col(layout.day).cast("string").alias("day")).agg(
        F.md5(F.array_join(F.array_sort(F.collect_list(name)), ",")).alias("files")
    )


def append(df: DataFrame, path: str, layout: Layout) -> None:
    arrange(conform(df, layout), layout).write.mode("append").partitionBy(layout.day).parquet(path)


def upsert_rows(
    old: DataFrame, new: DataFrame, keys: Sequence[str], newest_by: str | None = None
) -> DataFrame:
    """Rows of ``old`` updated and extended by ``new``; both have unique, non-NULL keys.

    With the same columns on both sides this is an anti join and a union: a small batch
    is broadcast after its size is measured and the old rows are not shuffled.  Columns
    the batch lacks keep their old value on matched rows.  ``newest_by`` keeps the old
    row where it is the newer one, for batches that may arrive out of order.
    """
    keys = list(keys)
    if newest_by is not None:
        both = old.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)))
        return latest_per(both, keys, [newest_by, "_batch"]).drop("_batch")
    if set(old.columns) == set(new.columns):
        return old.join(new.select(*keys), keys, "left_anti").unionByName(new)
    old_rows = old.select(*keys, F.struct(*old.columns).alias("_old"))
    new_rows = new.select(*keys, F.struct(*new.columns).alias("_new"))
    joined = old_rows.join(new_rows, keys, "full_outer")
    values = []
    for column in old.columns:
        if column in keys:
            values.append(F.col(column))
        elif column in new.columns:
            matched = F.when(F.col("_new").isNotNull(), F.col(f"_new.{column}"))
            values.append(matched.otherwise(F.col(f"_old.{column}")).alias(column))
        else:
            values.append(F.col(f"_old.{column}").alias(column))
    return joined.select(*values)


def check_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise on NULL keys and on repeated keys in a batch, with the counts."""
    null_key = F.lit(False)
    for key in keys:
        null_key = null_key | F.col(key).isNull()
    nulls, repeats = (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .agg(
            F.coalesce(F.sum(F.when(null_key, F.col("_n"))), F.lit(0)),
            F.count_if(~null_key & (F.col("_n") > 1)),
        )
        .first()
    )
    if nulls or repeats:
        raise ValueError(f"upsert batch has {nulls} rows with NULL keys, {repeats} repeated keys")


def publish(spark: SparkSession, staged: str, path: str, layout: Layout) -> None:
    """Swap staged days into the table; safe to run again after an interruption."""
    days = spark.read.schema(_stored_schema(layout)).parquet(staged)
    # Staged files are already gathered by day; only the order inside them is kept up.
    sorted_days = days.sortWithinPartitions(*_order(layout))
    sorted_days.write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(layout.day).parquet(path)


def upsert(
    df: DataFrame,
    path: str,
    layout: Layout,
    keys: Sequence[str] | None = None,
    newest_by: str | None = None,
) -> None:
    """Insert or update by key; days without new rows keep their files.

    The batch is written once and read back, so its source is evaluated only once.  If
    the final swap is interrupted, ``publish(spark, staged, path, layout)`` with the
    folder named in the error completes it.
    """
    spark = df.sparkSession
    keys = list(keys or layout.upsert_keys)
    work = shared_folder(spark)
    given = [
        F.col(f.name).cast(f.dataType).alias(f.name)
        for f in layout.schema.fields
        if f.name in df.columns
    ]
    source = df.select(*given)
    source.write.parquet(f"{work}/batch")
    batch = spark.read.schema(source.schema).parquet(f"{work}/batch")
    check_keys(batch, keys)
    # One value per calendar day of the batch; the table's own partition list is longer.
    day = F.col(layout.day) if layout.partition_is_column else F.to_date(layout.time)
    days = [r[0] for r in batch.select(day).distinct().collect()]
    if days:
        old = read_days(spark, path, layout, days)
        merged = conform(upsert_rows(old, batch, keys, newest_by), layout)
        arrange(merged, layout).write.partitionBy(layout.day).parquet(f"{work}/merged")
        try:
            publish(spark, f"{work}/merged", path, layout)
        except Exception as error:
            error.add_note(f"staged days are complete in {work}/merged; publish() them again")
            raise
    delete(spark, work)


def expire(df: DataFrame, time: str, as_of: str, days: int | None) -> DataFrame:
    """Rows whose day partition has not reached its age limit."""
    if days is None:
        return df
    limit = F.date_sub(F.to_date(instant(as_of)), days)
    return df.filter(F.to_date(time) > limit)


def expired_days(df: DataFrame, time: str, as_of: str, days: int) -> DataFrame:
    """Day partitions past their age limit, with their row counts."""
    limit = F.date_sub(F.to_date(instant(as_of)), days)
    return (
        df.groupBy(F.to_date(time).alias("day"))
        .agg(F.count("*").alias("n_rows"))
        .filter(F.col("day") <= limit)
    )


def drop_expired(spark: SparkSession, path: str, layout: Layout, as_of: str) -> list[str]:
    """Delete the folders of expired days; no data file is read or rewritten."""
    if layout.retention_days is None:
        return []
    files, location = located(spark, path)
    limit = spark.range(1).select(
        F.date_sub(F.to_date(instant(as_of)), layout.retention_days).cast("string")
    ).first()[0]
    dropped = []
    for status in files.listStatus(location):
        name = status.getPath().getName()
        prefix, _, day = name.partition("=")
        if prefix == layout.day and day <= limit:
            files.delete(status.getPath(), True)
            dropped.append(day)
    return sorted(dropped)


def truncate(spark: SparkSession, path: str, layout: Layout) -> None:
    """Empty the table; its schema stays declared."""
    empty = spark.createDataFrame([], _stored_schema(layout))
    empty.write.mode("overwrite").partitionBy(layout.day).parquet(path)
