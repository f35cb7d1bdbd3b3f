"""Keyed upsert and delete as one join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.config import ORDER_COLUMNS, TableSpec
from tidelog.functions.events import DELETE

MODES = ("ordered", "reference")


def apply_changes(
    target: DataFrame, changes: DataFrame, spec: TableSpec, mode: str = "ordered"
) -> DataFrame:
    """Next state of ``target`` after ``changes`` (both one row per key).

    ``ordered`` (default) keeps the newer of the two rows by event time, log
    sequence and offset, and keeps deletes as rows.  It is associative and safe
    to repeat, so batches may come late, again, or in any grouping and still end
    at what one pass over the whole history gives.

    ``reference`` applies the three merge clauses in order: a matched delete
    removes the row whatever its age; a matched change not older than the row
    replaces it; an unmatched non-delete is inserted.  Its result depends on
    how the history was cut into batches.

    Both sides hold each key once, so the join has no hot key.  When ``target``
    is stored bucketed by key only ``changes`` is shuffled.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")

    keys = spec.key_names
    columns = schemas.state(spec).names
    old = target.select(*keys, F.struct(*columns).alias("_old"))
    new = changes.select(*keys, F.struct(*columns).alias("_new"))
    joined = old.join(new, keys, "full_outer")

    merged = joined.select(next_row(mode).alias("_row")).where(F.col("_row").isNotNull())
    return merged.select(*[F.col(f"_row.{c}").alias(c) for c in columns])


def next_row(mode: str = "ordered") -> Column:
    """The row that a join of ``_old`` and ``_new`` leaves for a key; null if it is gone."""
    is_old, is_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    if mode == "ordered":
        newer = _order("_new") >= _order("_old")
        return F.when(is_new & (~is_old | newer), F.col("_new")).otherwise(F.col("_old"))
    delete = F.col("_new.op_type") == DELETE
    current = F.col("_new.source_ts_ms") >= F.coalesce(F.col("_old.source_ts_ms"), F.lit(0))
    return (
        F.when(is_old & is_new & delete, F.lit(None))
        .when(is_old & is_new & current, F.col("_new"))
        .when(is_old, F.col("_old"))
        .when(~delete, F.col("_new"))
    )


def _order(side: str):
    return F.struct(*[F.col(f"{side}.{c}") for c in ORDER_COLUMNS])
