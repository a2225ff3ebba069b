"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from .files import delete


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings that change results or plans; all are runtime settings.

    * UTC session zone: every local-time expression starts from UTC.
    * AQE: partition coalescing, skew-join splitting and size-checked broadcasts.
    * Co-partitioning on a subset of the join keys: a frame already partitioned by
      (key, block) joins on (key, block, hour) without being shuffled again.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return spark


def build(app_name: str = "slotcast", master: str | None = None, **conf: str) -> SparkSession:
    """Session for scripts and tests; a cluster deployment brings its own."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which every executor can reach.

    A local folder is created only where the session runs in one process (tests, a laptop);
    a cluster that names none is an error, as executors would write to their own disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        master = spark.sparkContext.master
        if not re.match(r"local(\[.*\])?$", master):
            raise RuntimeError(f"spark.checkpoint.dir names no shared folder for {master}")
        return tempfile.mkdtemp(prefix="slotcast-")
    return f"{base.rstrip('/')}/slotcast-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Iterative fits cut their lineage here; a folder is set only where none is named."""
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def stage(df: DataFrame) -> DataFrame:
    """Write a frame once to the shared folder and go on from the files.

    For frames that are expensive and read several times; unlike a cache it survives the
    loss of executors and cuts the lineage.  The files stay: where the frame is done with
    inside one function, use ``staged``.
    """
    return _write(df, shared_folder(df.sparkSession))


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """Like ``stage``, and the files are removed at the end of the block."""
    path = shared_folder(df.sparkSession)
    try:
        yield _write(df, path)
    finally:
        delete(df.sparkSession, path)


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
