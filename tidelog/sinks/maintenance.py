"""Upkeep of a lake: compaction, version retention, orphan removal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.events import DELETE
from tidelog.sinks.keyed import KeyedTable
from tidelog.sinks.lake import DAILY, DOMAIN, SILVER, VERSIONED, Lake

# Bytes of a row in memory for every column (numbers and pointers), and those that a sort adds.
_COLUMN_BYTES, _SORT_BYTES = 9, 24


def compact_bronze(
    lake: Lake,
    target_bytes: int = 512 * 1024 * 1024,
    table: KeyedTable | None = None,
    task_bytes: int = 512 * 1024 * 1024,
) -> tuple[int, int] | None:
    """Rewrite the small batches since the last compaction as larger files.

    Only batches that Silver and Gold already cover are taken, so no incremental
    step ever sees half of a compacted piece.  Older pieces are not rewritten:
    the work follows the new data, not the history.  ``table`` is Silver where it is kept
    by key.  A file holds at most about ``target_bytes``, and no more rows than take ``task_bytes`` in
    memory, as one task sorts them: rows that compress well give smaller files, not larger tasks.
    Returns the first and last batch number, or None when fewer than two batches are waiting.
    """
    layers = [DAILY] + ([DOMAIN] if lake.spec.domain_column else [])
    silver = table.version() if table else lake.version(SILVER)
    covered = min(silver, *(lake.version(t) for t in layers))
    first, waiting = lake.loose_batches(through=covered)
    if len(waiting) < 2:
        return None
    last = waiting[-1]
    size = sum(lake.folders.size("bronze", f"batch={n}") for n in waiting)
    rows = lake.bronze(after=first - 1, through=last)
    files = max(1, -(-size // target_bytes), -(-_memory_bytes(rows) // task_bytes))
    # Rows of one log partition and offset range stay together, so that readers
    # can skip files by offset and time.
    ordered = rows.repartitionByRange(
        files, "kafka_topic", "kafka_partition", "kafka_offset"
    ).sortWithinPartitions("kafka_topic", "kafka_partition", "kafka_offset")
    lake.write_compacted(ordered, first, last)
    return first, last


def _memory_bytes(rows: DataFrame) -> int:
    """About what the rows take in memory while they are sorted, from one pass over their texts."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in rows.schema if f.dataType.typeName() in ("string", "binary")]
    width = sum(texts, F.lit(_COLUMN_BYTES * len(rows.columns) + 4 * len(texts) + _SORT_BYTES))
    return rows.agg(F.sum(width).alias("bytes")).first()["bytes"] or 0


def drop_compacted(lake: Lake) -> list[int]:
    """Delete the loose batches that a committed compacted piece replaces.

    Run it later than any reader that may still hold the old file list.
    """
    return lake.drop_replaced()


def retire_versions(lake: Lake, keep: int = 5) -> dict[str, list[int]]:
    """Keep the newest ``keep`` versions of Silver and Gold."""
    return {table: lake.retire(table, keep) for table in VERSIONED}


def forget_deletes(lake: Lake, before_ms: int) -> int | None:
    """Drop deleted keys last heard of before ``before_ms`` from the newest Silver.

    Silver keeps deleted keys so that a late older event cannot bring one back.
    Choose a time before which no more events are expected.
    """
    version = lake.version(SILVER)
    if version < 0:
        return None
    gone = (F.col("op_type") == DELETE) & (F.col("source_ts_ms") < before_ms)
    kept = lake.read(SILVER, version).where(~F.coalesce(gone, F.lit(False)))
    return lake.publish(SILVER, kept, version, merged_onto=version, replace=True)


def remove_orphans(lake: Lake) -> list[str]:
    """Delete folders of writes that never committed.  Not while a job is running."""
    return lake.drop_unfinished()
