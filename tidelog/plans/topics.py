"""One stream over many topics, dealt out to their lakes within each micro-batch."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog import schemas
from tidelog.plans.jobs import ingest, run_stages, run_together
from tidelog.sinks.files import Folders
from tidelog.sinks.keyed import KeyedTable
from tidelog.sinks.lake import Lake
from tidelog.streaming.layers import process_batch

log = logging.getLogger(__name__)

_QUERY_ID = "sql.streaming.queryId"

# Records of a file that a batch is dealt out into.  A file is read by one task, so that small ones spread evenly.
_FILE_RECORDS = 25_000


def start_topics(
    change_log: DataFrame,
    lakes: Mapping[str, Lake],
    checkpoint: str,
    staging: str,
    *,
    tables: Mapping[str, KeyedTable] | None = None,
    query_name: str | None = None,
    trigger_seconds: int | None = 30,
    **options,
) -> StreamingQuery:
    """Start one query that feeds the lake of every topic in ``lakes``.

    ``change_log`` is subscribed to all of them.  Each micro-batch is read once and written below
    ``staging`` by topic; then every topic takes its own part through its layers (``tables``: Silver by
    key, per topic; ``options``: see :func:`tidelog.streaming.layers.process_batch`).  A topic that fails does not
    keep the others from finishing.  The query stops after such a batch, or one with records of a
    topic without a lake, and names what failed; on a restart the same batch is repeated, where the
    topics that had finished find their batch committed.
    """
    if not lakes:
        raise ValueError("at least one topic is needed")
    spark = next(iter(lakes.values())).spark
    folders, tables = Folders(spark, staging), dict(tables or {})

    def micro_batch(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty(_QUERY_ID) or query_name or "topics"
        name = f"{query_id}-{batch_id}"
        deal_out(batch, folders, name)
        process_topics(topics_of(spark, folders, name), name, lakes, tables, **options)
        # The newest one stays, as only it can be repeated.
        for old in folders.names("topics"):
            if old != name and old.startswith(f"{query_id}-"):
                folders.drop("topics", old)

    writer = change_log.writeStream.foreachBatch(micro_batch).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if trigger_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{trigger_seconds} seconds").start()


def deal_out(batch: DataFrame, folders: Folders, name: str) -> None:
    """Write the records of a batch by topic, in one pass, unless that is done."""
    if not folders.is_done("topics", name):
        writer = batch.select(*schemas.CHANGE_LOG.names).write.mode("overwrite").partitionBy("topic")
        writer.option("maxRecordsPerFile", _FILE_RECORDS).parquet(folders.at("topics", name))


def topics_of(spark, folders: Folders, name: str) -> dict[str, DataFrame]:
    """The records of each topic that the batch has."""
    if not any(n.startswith("topic=") for n in folders.names("topics", name)):
        return {}
    rows = spark.read.schema(schemas.CHANGE_LOG).parquet(folders.at("topics", name))
    rows = rows.select(*schemas.CHANGE_LOG.names)
    # One row per topic; read from the folder names alone.
    found = sorted(r.topic for r in rows.select("topic").distinct().collect() if r.topic is not None)
    return {topic: rows.where(F.col("topic") == topic) for topic in found}


def process_topics(
    parts: Mapping[str, DataFrame],
    owner: str,
    lakes: Mapping[str, Lake],
    tables: Mapping[str, KeyedTable] | None = None,
    **options,
) -> None:
    """Every topic's records through its layers; failures are raised together once all have run.

    Topics run side by side, as one alone leaves cores idle between and within its many small
    steps.  Those that share a lake follow one another.
    """

    def stage(topic: str, rows: DataFrame):
        def run() -> None:
            if topic not in lakes:
                raise ValueError(f"unknown topic {topic!r} (available: {sorted(lakes)})")
            process_batch(rows, owner, lakes[topic], table=(tables or {}).get(topic), **options)

        return run

    chains: dict[str, dict] = {}
    for topic, rows in parts.items():
        where = lakes[topic].root if topic in lakes else ""
        chains.setdefault(where, {})[topic] = stage(topic, rows)
    run_together(list(chains.values()), next((rows.sparkSession for rows in parts.values()), None))


def ingest_topics(change_log: DataFrame, lakes: Mapping[str, Lake], dedupe: str = "exact") -> dict[str, object]:
    """Append a batch scan of several topics to the histories of their lakes; rows added by topic.

    Every topic is tried; those that failed are raised together.  Records of other topics are left out.
    """

    def stage(topic: str, lake: Lake):
        return lambda: ingest(change_log.where(F.col("topic") == topic), lake, dedupe)

    return run_stages({topic: stage(topic, lake) for topic, lake in lakes.items()})
