"""Newest row per key as stream state.

The state of a key is its newest event, deletes included, on the session's state store.
A micro-batch emits the keys whose newest row it changed, one row each, so Silver is merged
from those rows alone: no history is read and nothing is ranked again.

Without expiry the state is a ``max_by`` aggregate in update mode, made of built-ins.  With
expiry it is a ``transformWithState`` processor, whose timers drop a deleted key some time
after its delete was processed; a live key stays.  Timers need a store with column families, so
that query runs on RocksDB whatever the session has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog import schemas
from tidelog.config import TableSpec
from tidelog.functions import order_key
from tidelog.operators import parse_events
from tidelog.operators.latest import state_rows
from tidelog.operators.newest_row import NewestRow
from tidelog.session import BASE_CONF
from tidelog.sinks.keyed import KeyedTable

_QUERY_ID = "sql.streaming.queryId"
_EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
_STORE = "spark.sql.streaming.stateStore.providerClass"


def newest_rows(events: DataFrame, spec: TableSpec, image: str = "coalesce", forget_deletes_ms: int | None = None) -> DataFrame:
    """Stream of the rows (Silver's columns and the merge's) that became their key's newest.

    ``events`` is a stream of Bronze rows.  ``forget_deletes_ms`` drops the state of a deleted key so
    long after the delete was processed; an event that is older than the delete and comes
    later than that brings the key back, so choose it beyond any replay.
    """
    columns = schemas.state(spec).names
    rows = state_rows(events, spec, image)
    if forget_deletes_ms is None:
        best = rows.groupBy(*spec.key_names).agg(F.max_by(F.struct(*columns), order_key()).alias("row"))
        return best.select("row.*")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.state(spec))
    processor = NewestRow(columns, f"{ddl}, `_until` bigint", forget_deletes_ms)
    keyed = rows.groupBy(*spec.key_names)
    return keyed.transformWithState(processor, schemas.state(spec), "Update", "ProcessingTime")


def start_newest(
    change_log: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    *,
    image: str = "coalesce",
    forget_deletes_ms: int | None = None,
    query_name: str | None = None,
    trigger_seconds: int | None = 30,
) -> StreamingQuery:
    """Keep ``table`` at the newest rows of the stream.

    Each micro-batch's changed rows are written first (the state is read once), then merged into the
    partitions they touch.  A table belongs to the checkpoint that fills it: another query would
    count its batches anew, so it is refused.
    """
    columns = schemas.state(table.spec).names

    def merge(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty(_QUERY_ID)
        owners = table.folders.names("filled_by")
        if owners not in ([], [query_id]):
            raise ValueError(f"the table is filled by query {owners[0]}, from another checkpoint")
        table.folders.make("filled_by", query_id)
        if not table.folders.is_done("changed", str(batch_id)):
            batch.select(*columns).write.mode("overwrite").parquet(table.folders.at("changed", str(batch_id)))
        changes = table.spark.read.schema(schemas.state(table.spec)).parquet(table.folders.at("changed", str(batch_id)))
        table.merge(changes, batch_id)
        for old in table.folders.names("changed"):
            if int(old) < batch_id:
                table.folders.drop("changed", old)

    rows = newest_rows(parse_events(change_log, table.spec), table.spec, image, forget_deletes_ms)
    writer = rows.writeStream.foreachBatch(merge).outputMode("update").option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    settings = {}
    if forget_deletes_ms is not None:
        settings[_STORE] = BASE_CONF[_STORE]
    if trigger_seconds is None:
        # Timers on the clock always ask for another batch, so a drained stream would never end: here
        # they run with the next batch that has rows.
        settings[_EMPTY_BATCHES] = "false"
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{trigger_seconds} seconds")
    # A query takes the session's settings over when it starts.
    conf = table.spark.conf
    known = {key: conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            conf.set(key, value)
        return writer.start()
    finally:
        for key, value in known.items():
            conf.set(key, value)
