"""Jobs: ingest, transform, the whole chain, the continuous stream."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidelog.config import Settings
from tidelog.operators import insert_if_absent, parse_events
from tidelog.plans import reports
from tidelog.plans.layers import (
    DEDUPE,
    advance_gold,
    advance_silver,
    fresh_records,
    rebuild_gold,
    rebuild_silver,
)
from tidelog.sinks.lake import Lake
from tidelog.sinks.maintenance import compact_bronze, drop_compacted, retire_versions
from tidelog.sinks.tables import append_rows, create_if_absent
from tidelog.streaming.layers import start_layers
from tidelog.streaming.progress import watch_progress

log = logging.getLogger(__name__)

__all__ = [
    "DEDUPE",
    "LAYERS",
    "JobFailed",
    "await_all",
    "drain",
    "ingest",
    "maintain",
    "run_all",
    "run_stages",
    "run_together",
    "seed",
    "stop",
    "stream",
    "stream_bronze",
    "transform",
    "verify",
]

LAYERS = ("silver", "gold", "all")

# Chains of stages that run at once.
_TOGETHER = 4


class JobFailed(RuntimeError):
    """One or more stages failed; ``failures`` maps stage to exception."""

    def __init__(self, failures: dict[str, Exception]):
        self.failures = failures
        super().__init__("; ".join(f"{stage}: {error}" for stage, error in failures.items()))


def ingest(change_log: DataFrame, lake: Lake, dedupe: str = "exact") -> int:
    """Append the records of a batch scan that Bronze does not hold yet.

    See :func:`tidelog.plans.layers.fresh_records` for ``dedupe``.  An empty scan
    leaves the history as it is.
    """
    fresh = fresh_records(change_log, lake, dedupe)
    number = lake.reserve(f"ingest-{uuid.uuid4().hex}")
    rows = lake.write_bronze(parse_events(fresh, lake.spec), number)
    log.info("bronze batch %d: %s rows", number, rows)
    return rows or 0


def transform(lake: Lake, layer: str = "all", full: bool = False) -> dict[str, int | None]:
    """Build Silver and/or Gold; returns rows written (None: already up to date).

    ``full`` builds from the whole history, otherwise only batches not covered
    yet are added.  Both give the same tables.
    """
    if layer not in LAYERS:
        raise ValueError(f"layer must be one of {LAYERS}, not {layer!r}")
    rows: dict[str, int | None] = {}
    if layer in ("silver", "all"):
        rows["silver"] = rebuild_silver(lake) if full else advance_silver(lake)
    if layer in ("gold", "all"):
        rows.update(rebuild_gold(lake) if full else advance_gold(lake))
    return rows


def run_stages(stages: dict[str, Callable[[], object]]) -> dict[str, object]:
    """Run every stage in order even if one fails, then raise for the failed ones."""
    results, failures = {}, {}
    for name, stage in stages.items():
        try:
            results[name] = stage()
        except Exception as error:  # noqa: BLE001 - reported together below
            log.exception("stage %s failed", name)
            failures[name] = error
    if failures:
        raise JobFailed(failures)
    return results


def run_together(chains: Sequence[dict[str, Callable[[], object]]], spark: SparkSession | None) -> dict[str, object]:
    """Run chains of stages side by side, the stages of a chain in order, then raise for all that failed.

    Each chain has a thread, which inherits the caller's local properties: stopping a
    streaming query also stops what its chains run.
    """
    if len(chains) < 2:
        return run_stages(chains[0]) if chains else {}
    results, failures = {}, {}
    with ThreadPoolExecutor(_TOGETHER) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(partial(run_stages, chain))) for chain in chains]
        for chain, future in zip(chains, started):
            try:
                results |= future.result()
            except JobFailed as error:
                failures |= error.failures
    if failures:
        raise JobFailed(failures)
    return results


def seed(
    spark: SparkSession,
    rows: DataFrame,
    table: str,
    key: Sequence[str],
    location: str | None = None,
) -> None:
    """Insert rows whose key the table does not hold; create the table if absent.

    Running it again inserts nothing, in this session or another.  ``location`` is the
    table's folder, by default one below the warehouse.
    """
    if location is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        location = f"{warehouse}/seeded/{table.replace('.', '/')}"
    create_if_absent(spark, table, rows.schema, location=location)
    append_rows(insert_if_absent(spark.table(table), rows, key), table)


def run_all(change_log: Callable[[], DataFrame], lake: Lake, dedupe: str = "exact") -> dict:
    """Bronze, Silver, Gold, then the row counts of every layer."""
    return run_stages(
        {
            "bronze": lambda: ingest(change_log(), lake, dedupe),
            "silver": lambda: transform(lake, "silver"),
            "gold": lambda: transform(lake, "gold"),
            "verify": lambda: verify(lake),
        }
    )


def verify(lake: Lake) -> dict[str, int]:
    """Row count of every layer table there is."""
    lake.register()
    result = reports.run(lake.spark, lake.spec, "counts", lake.prefix)
    if "row counts" not in result:
        return {}
    # One row per layer table.
    return {row["layer"]: row["rows"] for row in result["row counts"].collect()}


def stream(
    change_log: DataFrame,
    lake: Lake,
    settings: Settings,
    *,
    available_now: bool = False,
    progress: str | None = None,
    **options,
) -> StreamingQuery:
    """Start the continuous three-layer query.

    Its progress is logged and written as rows to the folder ``progress``, by default
    ``stream_progress`` below the lake.
    """
    if not settings.checkpoint:
        raise ValueError("STREAMING_CHECKPOINT is not set")
    watch_progress(lake.spark, progress or lake.folders.at("stream_progress"))
    return start_layers(
        change_log,
        lake,
        settings.checkpoint,
        query_name=settings.query_name,
        trigger_seconds=None if available_now else settings.trigger_seconds,
        **options,
    )


def stream_bronze(
    sources: Iterable[tuple[DataFrame, Lake]],
    checkpoint_root: str,
    trigger_seconds: int | None = 30,
) -> list[StreamingQuery]:
    """One Bronze-only query per topic, each with its own checkpoint."""
    queries: list[StreamingQuery] = []
    try:
        for change_log, lake in sources:
            topic = lake.spec.topic.replace(".", "_")
            query = start_layers(
                change_log,
                lake,
                f"{checkpoint_root.rstrip('/')}/{topic}",
                query_name=f"bronze_{topic}",
                trigger_seconds=trigger_seconds,
                bronze_only=True,
            )
            queries.append(query)
    except Exception:
        stop(queries)
        raise
    return queries


def await_all(queries: list[StreamingQuery], poll_seconds: int = 5) -> None:
    """Wait until every query ends; the first failure stops the others and is raised.

    Only these queries are watched, whatever else the session runs.
    """
    waiting = list(queries)
    try:
        while waiting:
            # Raises when the query has failed.
            waiting = [q for q in waiting if not q.awaitTermination(poll_seconds)]
    except KeyboardInterrupt:
        log.info("interrupted, stopping")
    finally:
        stop(queries)


def stop(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        query.stop()


def drain(
    change_log: DataFrame, lake: Lake, settings: Settings, *, progress: str | None = None, **options
) -> None:
    """Run the stream over what is there, to the end; every layer covers all of it afterwards."""
    query = stream(change_log, lake, settings, available_now=True, progress=progress, **options)
    await_all([query])
    transform(lake)


def maintain(lake: Lake, keep: int = 5) -> dict[str, object]:
    """Drop the batches that an earlier run compacted, compact Bronze, retire old versions and reservations.

    Readers of a compacted batch have until the next run to finish.
    """
    return run_stages(
        {
            "replaced": lambda: drop_compacted(lake),
            "compact": lambda: compact_bronze(lake),
            "retire": lambda: retire_versions(lake, keep),
            "owners": lake.forget_owners,
        }
    )
