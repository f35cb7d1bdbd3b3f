"""Change counts per event-time window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.functions import event_time


def changes_per_window(
    events: DataFrame, width: str = "5 minutes", watermark: str | None = "10 minutes"
) -> DataFrame:
    """Events per tumbling window and operation, for a batch or a stream.

    On a stream the watermark bounds the state; in append and update mode events
    later than it are left out.  On a batch it has no effect.
    """
    if "source_ts" not in events.columns:
        events = events.withColumn("source_ts", event_time(F.col("source_ts_ms")))
    if watermark:
        events = events.withWatermark("source_ts", watermark)
    counted = events.groupBy(F.window("source_ts", width), "op_type").agg(
        F.count("*").alias("event_count")
    )
    return counted.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "op_type",
        "event_count",
    )


def start_window_counts(
    events: DataFrame,
    path: str,
    checkpoint: str,
    *,
    width: str = "5 minutes",
    watermark: str = "10 minutes",
    trigger_seconds: int | None = 30,
) -> StreamingQuery:
    """Write the windows that each micro-batch changed, with their counts so far.

    :func:`window_counts` reads them.  Open windows are there as well as closed ones; a
    repeated micro-batch writes its folder again.
    """

    def changed(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    writer = (
        changes_per_window(events, width, watermark)
        .writeStream.foreachBatch(changed)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
    )
    if trigger_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{trigger_seconds} seconds").start()


def window_counts(spark: SparkSession, path: str) -> DataFrame:
    """The latest count of every window and operation that :func:`start_window_counts` wrote."""
    return (
        spark.read.parquet(path)
        .groupBy("window_start", "window_end", "op_type")
        .agg(F.max_by("event_count", "batch").alias("event_count"))
    )
