"""One streaming query that keeps Bronze, Silver and Gold up to date."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidelog.config import TableSpec
from tidelog.operators import daily_changes, domain_counts, drop_seen_events, parse_events
from tidelog.plans.layers import (
    DEDUPE,
    advance_daily,
    advance_gold,
    advance_keyed,
    advance_silver,
    fresh_records,
)
from tidelog.sinks import tables
from tidelog.sinks.keyed import KeyedTable
from tidelog.sinks.lake import DAILY, SILVER, Lake
from tidelog.sinks.maintenance import retire_versions
from tidelog.streaming.progress import observe_events
from tidelog.streaming.replays import drop_replayed

log = logging.getLogger(__name__)

# Set by Spark on the thread that runs a micro-batch.
_QUERY_ID = "sql.streaming.queryId"


def start_layers(
    change_log: DataFrame,
    lake: Lake,
    checkpoint: str,
    *,
    query_name: str | None = None,
    trigger_seconds: int | None = 30,
    merge_every: int = 1,
    merge_share: float = 0.0,
    keep_versions: int = 5,
    mode: str = "ordered",
    dedupe: str = "none",
    bronze_only: bool = False,
    register: bool = False,
    table: KeyedTable | None = None,
    replay_within: str | None = None,
    metrics: bool = False,
) -> StreamingQuery:
    """Start the query; ``trigger_seconds=None`` drains what is there and stops.

    Each micro-batch is first committed to Bronze.  Later steps read that
    committed batch, so nothing is cached and a lost executor costs a re-read,
    not a re-parse of the source.  ``merge_every`` merges several batches at
    once, and ``merge_share`` waits until the batches not merged yet have that share of
    Silver's bytes: then what a merge rewrites stays within 1 / ``merge_share`` times the
    changes, however large Silver is, and :func:`tidelog.plans.layers.fresh_state` reads
    the rest.  Only the ``keep_versions`` newest versions of each table stay.  A step that fails stops the query; after a
    restart the same batch is repeated and resumes where it broke off.

    The checkpoint already keeps one query from reading a record twice.
    ``dedupe`` (see :func:`tidelog.plans.layers.fresh_records`) also covers a
    replay of the log with a new checkpoint.  ``replay_within`` leaves out copies that come within
    that span of log time, with bounded state and without a look at what is stored
    (see :func:`tidelog.streaming.replays.drop_replayed`).  ``register`` moves the SQL names to
    the new tables after every merge.

    With ``table`` Silver is that partitioned table: a merge then costs what its changes
    touch, and the domain counts follow by differences.

    ``metrics`` counts events by operation, unreadable ones and those without a key while
    they pass; the counts are part of each progress report.  Events are then parsed in the stream
    itself, so it needs ``dedupe="none"``.
    """
    if merge_every < 1:
        raise ValueError("merge_every must be at least 1")
    if trigger_seconds is None:
        merge_every, merge_share = 1, 0.0  # a drained stream ends merged
    if dedupe not in DEDUPE:
        raise ValueError(f"dedupe must be one of {DEDUPE}, not {dedupe!r}")
    if metrics and dedupe != "none":
        raise ValueError("metrics need dedupe='none': records are compared before they are parsed")
    if replay_within:
        change_log = drop_replayed(change_log, replay_within)
    if metrics:
        change_log = observe_events(parse_events(change_log, lake.spec), lake.spec)

    def micro_batch(batch: DataFrame, batch_id: int) -> None:
        context = batch.sparkSession.sparkContext
        query_id = context.getLocalProperty(_QUERY_ID) or query_name or "stream"
        merge = not bronze_only and (batch_id + 1) % merge_every == 0
        owner = f"{query_id}-{batch_id}"
        process_batch(
            batch,
            owner,
            lake,
            merge=merge,
            merge_share=merge_share,
            mode=mode,
            dedupe=dedupe,
            table=table,
            parsed=metrics,
        )
        if merge:
            retire_versions(lake, keep_versions)
        if register and merge:
            lake.register()

    return _start(change_log, micro_batch, checkpoint, query_name, trigger_seconds)


def start_table_layers(
    change_log: DataFrame,
    spec: TableSpec,
    checkpoint: str,
    *,
    query_name: str | None = None,
    trigger_seconds: int | None = 30,
    replay_within: str | None = None,
) -> StreamingQuery:
    """The same three layers in catalog tables that support ``MERGE``.

    :func:`tidelog.sinks.bootstrap` creates them.  The catalog's append has no batch
    identity, so a repeated micro-batch leaves out the log positions that Bronze holds.
    ``replay_within`` leaves out copies in the stream itself, with bounded state; a micro-batch that
    is repeated after a failure still needs the comparison, so only later batches go without it.
    """
    first = {"batch": None}

    def micro_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                log.info("batch %d: no new events", batch_id)
                return
            session = batch.sparkSession
            # The first batch of a run may be a repeated one.
            first["batch"] = batch_id if first["batch"] is None else first["batch"]
            known = replay_within is not None and batch_id != first["batch"]
            fresh = batch if known else drop_seen_events(batch, session.table(spec.bronze_table))
            tables.append_rows(fresh, spec.bronze_table)
            tables.merge_into(batch, spec, spec.silver_table)
            if spec.domain_column:
                domains = domain_counts(session.table(spec.silver_table), spec)
                tables.replace_table(domains, spec.domain_table)
            daily = daily_changes(session.table(spec.bronze_table))
            tables.replace_table(daily, spec.daily_table)
        finally:
            batch.unpersist()

    if replay_within:
        change_log = drop_replayed(change_log, replay_within)
    events = parse_events(change_log, spec)
    return _start(events, micro_batch, checkpoint, query_name, trigger_seconds)


def _start(
    source: DataFrame,
    micro_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    query_name: str | None,
    trigger_seconds: int | None,
) -> StreamingQuery:
    writer = source.writeStream.foreachBatch(micro_batch).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if trigger_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{trigger_seconds} seconds").start()


def process_batch(
    change_log: DataFrame,
    owner: str,
    lake: Lake,
    *,
    merge: bool = True,
    merge_share: float = 0.0,
    mode: str = "ordered",
    dedupe: str = "none",
    table: KeyedTable | None = None,
    parsed: bool = False,
) -> None:
    """Bronze, then Silver, then Gold for one batch.  Safe to repeat.

    ``parsed`` says that ``change_log`` holds Bronze rows already.
    """
    number = lake.reserve(owner)
    events = change_log if parsed else parse_events(fresh_records(change_log, lake, dedupe), lake.spec)
    rows = lake.write_bronze(events, number)
    log.info("batch %s: bronze batch %d, rows %s", owner, number, rows)
    merged = table.version() if table else lake.version(SILVER)
    waiting = lake.batches(after=min(merged, lake.version(DAILY)))
    # A batch without rows is no reason to merge, but earlier ones may still wait.
    if not merge or not waiting or (rows == 0 and waiting == [number]):
        return
    if table:
        advance_keyed(lake, table, mode)
        advance_daily(lake)
        return
    if merge_share and lake.waiting_share() < merge_share:
        return
    advance_silver(lake, mode)
    advance_gold(lake)
    log.info("batch %s: silver and gold at version %d", owner, number)
