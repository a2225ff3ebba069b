"""Places in a global order, without a window over all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage

#: ``monotonically_increasing_id`` holds the partition above these bits, the place in it below.
_PLACE_BITS = 33


def ranked(df: DataFrame, order: Sequence[str], name: str = "rank") -> DataFrame:
    """The rows with their place, from 0 on, in the order of the given columns.

    Rows are dealt into ranges and sorted there; each range's count, one number a partition,
    gives where the next begins.  Rows equal in all columns of ``order`` come in any order.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stage(placed.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", _PLACE_BITS)
    begins, total = [], 0
    for found in sorted(rows.groupBy(part.alias("part")).count().collect()):
        begins.append((found["part"], total))
        total += found["count"]
    starts = df.sparkSession.createDataFrame(begins, "_part long, _begin long")
    place = F.col("_id").bitwiseAND(F.lit(2**_PLACE_BITS - 1)) + F.col("_begin")
    # One row a partition, so the side is as small as the number of partitions.
    joined = rows.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return joined.select(*df.columns, place.alias(name))
