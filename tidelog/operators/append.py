"""Filters that make appending to the history idempotent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LOG_POSITION = ["topic", "partition", "offset"]


def drop_seen(log: DataFrame, bronze: DataFrame) -> DataFrame:
    """Records of ``log`` whose log position is not in ``bronze``, each once.

    Exact for any delivery order and for gaps.  Only history from the log's own lowest
    offset on is read.  Copies are reduced before the shuffle, and the anti join reuses
    its partitioning by log position.
    """
    lowest = log.agg(F.min("offset")).first()[0]  # one value
    if lowest is not None:
        bronze = bronze.where(F.col("kafka_offset") >= F.lit(lowest))
    seen = bronze.select(
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
    )
    once = log.dropDuplicates(_LOG_POSITION)
    return once.join(seen, _LOG_POSITION, "left_anti").select(*log.columns)


def drop_seen_events(events: DataFrame, bronze: DataFrame) -> DataFrame:
    """As :func:`drop_seen`, for parsed events."""
    named = {f"kafka_{c}": c for c in _LOG_POSITION}
    fresh = drop_seen(events.withColumnsRenamed(named), bronze)
    return fresh.withColumnsRenamed({v: k for k, v in named.items()})


def high_water_marks(bronze: DataFrame) -> DataFrame:
    """Highest stored offset of every log partition."""
    return bronze.groupBy("kafka_topic", "kafka_partition").agg(
        F.max("kafka_offset").alias("kafka_offset")
    )


def drop_older_than_marks(log: DataFrame, marks: DataFrame) -> DataFrame:
    """Records above the stored high-water mark of their log partition.

    For sources that deliver each partition in offset order (a broker).  ``marks``
    has one row per log partition; read from its own small table Spark sees its
    size and broadcasts it, so the log is filtered without a shuffle.
    """
    known = marks.select(
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("_mark"),
    )
    joined = log.join(known, ["topic", "partition"], "left")
    fresh = F.col("_mark").isNull() | (F.col("offset") > F.col("_mark"))
    return joined.where(fresh).select(*log.columns)
