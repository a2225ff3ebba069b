"""What several operators share: text rules, batches, staged frames and components.

Text rules.  A gap is a run of the six ASCII white-space characters, a word what lies
between gaps.  ``bytes.split()`` and ``bytes.lower()`` follow exactly these rules, so tasks
that run Python work on UTF-8 bytes.  A null text counts as an empty one everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast.session import stage

GAP_CHARS = " \t\n\x0b\x0c\r"
GAP = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def settings(spark: SparkSession) -> None:
    """Rows per Arrow batch, so that a batch of long texts stays within a few dozen MB."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


@contextmanager
def bounded_batches(spark: SparkSession, rows: int = 2000, size: str = "32m") -> Iterator[None]:
    """Arrow batches of so many rows and bytes at most for the jobs that run inside the block.

    The caller's settings are back afterwards, so nothing that runs Python may be left to be
    computed later.
    """
    limits = {"maxRecordsPerBatch": str(rows), "maxBytesPerBatch": size}
    before = {name: spark.conf.get(f"spark.sql.execution.arrow.{name}") for name in limits}
    try:
        for name, value in limits.items():
            spark.conf.set(f"spark.sql.execution.arrow.{name}", value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(f"spark.sql.execution.arrow.{name}", value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(column: Column | str) -> Column:
    """The text, an empty string for null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case; other letters stay."""
    return F.translate(column, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def columns(batch: pa.RecordBatch, *names: str) -> list[list]:
    """Columns as lists; texts as UTF-8 bytes."""
    out = []
    for name in names:
        column = batch.column(batch.schema.get_field_index(name))
        if pa.types.is_string(column.type):
            column = column.cast(pa.binary())
        elif pa.types.is_large_string(column.type):
            column = column.cast(pa.large_binary())
        out.append(column.to_pylist())
    return out


def parts(batch: pa.RecordBatch, name: str, most: int = 16_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``most`` bytes at most, or one text each."""
    text = batch.column(batch.schema.get_field_index(name))
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())).to_pylist()
    first, before = 0, 0
    for at, end in enumerate(ends):
        if end - before > most and at > first:
            yield batch.slice(first, at - first)
            first, before = at, ends[at - 1]
    if first < batch.num_rows:
        yield batch.slice(first)


def plain_docs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just (doc_id, text), whatever else the table carries; null texts become empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def count_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """Rows with the highest counts ``n``, ``most`` of them at most, without a sort.

    Counts fall into sixteen classes an octave, a thousand in all; the highest classes that
    together hold no more than ``most`` rows are taken.  Only the classes' sizes reach the
    driver, where a top-k would send ``most`` rows from every task.
    """
    octave = F.floor(16 * F.log2(F.col("n"))).cast("int")
    sizes = counts.groupBy(octave.alias("octave")).count().collect()
    held, least = 0, None
    for row in sorted(sizes, key=lambda r: -r["octave"]):
        held += row["count"]
        if held > most:
            break
        least = row["octave"]
    return counts.where(F.lit(False) if least is None else octave >= least)


def _are_stars(pairs: DataFrame) -> bool:
    """Whether each node of the distinct pairs (a, b) is either a centre b or has one centre."""
    ends = pairs.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(pairs.select("b", F.lit(0), F.lit(1)))
    places = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return places.where("up + down > 1").isEmpty()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component: its smallest node.

    Large-star and small-star in turn: each node links its larger neighbours, then its
    smaller ones, to the smallest node it sees, until every edge points at a component's
    smallest node.  Rounds grow with the logarithm of a component's size.  The stars are
    aggregates with a partial step and joins by node, so a node with many neighbours is no
    group in one task.  Each round is written to the shared folder, which cuts the lineage.

    No edge, no row; loops and repeated edges are ignored.
    """
    pairs = stage(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    for _ in range(max_rounds):
        if _are_stars(pairs):
            break
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = (
            both.where(F.col("b") > F.col("a"))
            .join(lowest, "a")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .where(F.col("a") != F.col("b"))
            .distinct()
        )
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lowest, "a")
        pairs = stage(
            small.select(F.col("b").alias("a"), F.col("low").alias("b"))
            .union(lowest.select("a", F.col("low").alias("b")))
            .where(F.col("a") != F.col("b"))
            .distinct()
        )
    else:
        raise RuntimeError("components did not settle")
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def batches(frames: Iterator[pa.RecordBatch], schema: pa.Schema, work) -> Iterator[pa.RecordBatch]:
    """``work(batch)`` gives lists of columns in the order of ``schema``."""
    for batch in frames:
        yield pa.RecordBatch.from_arrays(
            [pa.array(values, type=field.type) for values, field in zip(work(batch), schema)],
            schema=schema,
        )
