"""Change counts per event-time window that tell late events apart.

A stateful aggregate drops what is behind its watermark without a trace.  Here each micro-batch
tallies the events that are on time and writes the late ones aside, by the same rule: a
window is closed once its end is behind the greatest event time of all earlier
batches, less the allowed delay.  Tallies add up, so there is no state but the small
tables themselves, and the watermark depends on what was read, not on when.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.functions import event_time
from tidelog.sinks.files import Folders

_TALLIES = "window_start timestamp, window_end timestamp, op_type string, event_count bigint"


def start_window_tallies(
    events: DataFrame,
    path: str,
    checkpoint: str,
    *,
    width: str = "5 minutes",
    delay: str = "10 minutes",
    trigger_seconds: int | None = 30,
) -> StreamingQuery:
    """Tally ``events`` (``source_ts`` or ``source_ts_ms``, ``op_type``) below ``path``.

    :func:`window_tallies` reads the counts, :func:`late_events` the late rows.  A row without an
    event time is in no window and counts as late.  A repeated micro-batch writes the same again.
    """
    if "source_ts" not in events.columns:
        events = events.withColumn("source_ts", event_time(F.col("source_ts_ms")))

    def tally(batch: DataFrame, batch_id: int) -> None:
        folders = Folders(batch.sparkSession, path)
        late = F.col("source_ts").isNull()
        before = _newest(folders, below=batch_id)
        # The window of a row, also of one that is in none.
        window = F.window(F.coalesce("source_ts", F.lit("1970-01-01").cast("timestamp")), width)
        if before is not None:
            closed = F.timestamp_millis(F.lit(before)) - F.expr(f"INTERVAL {delay}")
            late = late | (F.col("_window.end") <= closed)
        placed = batch.withColumn("_window", window).withColumn("_late", late)
        placed.persist()
        try:
            newest = placed.agg(F.max(F.unix_millis("source_ts"))).first()[0]
            aside = placed.where("_late").drop("_late", "_window")
            aside.write.mode("overwrite").parquet(folders.at("late", f"batch={batch_id}"))
            counted = placed.where("not _late").groupBy("_window", "op_type").agg(F.count(F.lit(1)).alias("event_count"))
            counted.select(
                F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), "op_type", "event_count"
            ).write.mode("overwrite").parquet(folders.at("tallies", f"batch={batch_id}"))
        finally:
            placed.unpersist()
        if newest is not None:
            folders.make("seen", f"{batch_id:012d}={newest}")

    writer = events.writeStream.foreachBatch(tally).option("checkpointLocation", checkpoint)
    if trigger_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{trigger_seconds} seconds").start()


def window_tallies(spark: SparkSession, path: str, delay: str = "10 minutes") -> DataFrame:
    """Windows and operations with their counts, and whether the window is ``final``: no event can join it."""
    folders = Folders(spark, path)
    through = _folded(folders)
    parts = [folders.at("folded", f"through={through}")] if through >= 0 else []
    parts += [folders.at("tallies", f"batch={b}") for b in _batches(folders) if b > through]
    if not parts:
        return spark.createDataFrame([], f"{_TALLIES}, final boolean")
    newest = _newest(folders)
    final = F.lit(False)
    if newest is not None:
        final = F.col("window_end") <= F.timestamp_millis(F.lit(newest)) - F.expr(f"INTERVAL {delay}")
    rows = spark.read.schema(_TALLIES).parquet(*parts)
    return rows.groupBy("window_start", "window_end", "op_type").agg(F.sum("event_count").alias("event_count")).withColumn("final", final)


def late_events(spark: SparkSession, path: str) -> DataFrame:
    """The rows that came too late for their window, with the ``batch`` they came in."""
    return spark.read.option("basePath", Folders(spark, path).at("late")).parquet(Folders(spark, path).at("late"))


def fold_tallies(spark: SparkSession, path: str) -> int:
    """Add up the tallies so far into one table and drop them; returns the newest batch in it.

    Not while a stream writes.  A fold that broke off leaves readers with what they had.
    """
    folders = Folders(spark, path)
    batches, done = _batches(folders), _folded(folders)
    newest = max(batches, default=done)
    if newest > done:
        rows = window_tallies(spark, path).drop("final")
        rows.write.mode("overwrite").parquet(folders.at("folded", f"through={newest}"))
    for batch in batches:
        if batch <= newest:
            folders.drop("tallies", f"batch={batch}")
    for name in folders.names("folded"):
        if int(name.partition("=")[2]) < newest:
            folders.drop("folded", name)
    # Of the marks only the greatest time matters.
    marks = folders.names("seen")
    for name in sorted(marks, key=lambda n: int(n.partition("=")[2]))[:-1]:
        folders.drop("seen", name)
    return newest


def _batches(folders: Folders) -> list[int]:
    found = [int(n.partition("=")[2]) for n in folders.names("tallies")]
    return sorted(b for b in found if folders.is_done("tallies", f"batch={b}"))


def _folded(folders: Folders) -> int:
    found = [int(n.partition("=")[2]) for n in folders.names("folded") if folders.is_done("folded", n)]
    return max(found, default=-1)


def _newest(folders: Folders, below: int | None = None) -> int | None:
    """Greatest event time of all batches (before ``below``), in milliseconds."""
    marks = [n.partition("=") for n in folders.names("seen")]
    return max((int(ms) for batch, _, ms in marks if below is None or int(batch) < below), default=None)
