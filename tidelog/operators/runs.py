"""Stored log offsets as runs without gaps.

A log partition's offsets are mostly consecutive, so the positions that the history holds shrink
to a small table of (first, last) runs.  Runs are cut at multiples of ``BLOCK`` offsets: a block
is then the equality of the range join, no group of the window functions has more than a
block of offsets, and a log partition with most of the records is dealt over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Offsets of a block.
BLOCK = 4_096

_PLACE = ["kafka_topic", "kafka_partition", "block"]
COLUMNS = [*_PLACE, "first_offset", "last_offset"]
_POSITION = ["topic", "partition", "offset"]


def _block(offset: Column) -> Column:
    return F.floor(offset / BLOCK).cast("long")


def offset_runs(events: DataFrame) -> DataFrame:
    """Runs of consecutive offsets of ``events`` (Bronze rows, in any order, repeats included).

    Gaps and islands: within a block an offset less its rank is the same all along a run.
    """
    place = events.select(
        "kafka_topic", "kafka_partition", _block(F.col("kafka_offset")).alias("block"), "kafka_offset"
    ).where(F.col("kafka_offset").isNotNull())
    rank = F.dense_rank().over(Window.partitionBy(*_PLACE).orderBy("kafka_offset"))
    return (
        place.withColumn("island", F.col("kafka_offset") - rank)
        .groupBy(*_PLACE, "island")
        .agg(F.min("kafka_offset").alias("first_offset"), F.max("kafka_offset").alias("last_offset"))
        .select(*COLUMNS)
    )


def join_runs(*parts: DataFrame) -> DataFrame:
    """One table of runs from several: those that touch or overlap become one."""
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    by_first = Window.partitionBy(*_PLACE).orderBy("first_offset", "last_offset")
    reach = F.max("last_offset").over(by_first.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col("first_offset") > reach + 1).cast("int"), F.lit(1))
    return (
        rows.withColumn("opens", opens)
        .withColumn("island", F.sum("opens").over(by_first.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*_PLACE, "island")
        .agg(F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"))
        .select(*COLUMNS)
    )


def drop_stored(log: DataFrame, runs: DataFrame) -> DataFrame:
    """Records of ``log`` whose position is in no run, each once.

    Exact for any delivery order and for gaps; the history itself is not read.  Copies
    are reduced before the shuffle.  Spark broadcasts the runs if they are small.
    """
    known = runs.select(
        F.col("kafka_topic").alias("_topic"),
        F.col("kafka_partition").alias("_partition"),
        F.col("block").alias("_known_block"),
        "first_offset",
        "last_offset",
    )
    once = log.dropDuplicates(_POSITION).withColumn("_block", _block(F.col("offset")))
    inside = (
        once["topic"].eqNullSafe(known["_topic"])
        & once["partition"].eqNullSafe(known["_partition"])
        & (once["_block"] == known["_known_block"])
        & once["offset"].between(known["first_offset"], known["last_offset"])
    )
    return once.join(known, inside, "left_anti").select(*log.columns)
