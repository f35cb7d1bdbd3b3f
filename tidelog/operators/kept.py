"""Report tables that follow the history or a merge instead of being computed anew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.config import ORDER_COLUMNS
from tidelog.functions.events import DELETE


def newest_events(*parts: DataFrame, rows: int) -> DataFrame:
    """The ``rows`` newest events of all parts.

    The newest of a whole are among the newest of its parts, so the stored rows and
    those of a new batch are enough: history is never ordered again.
    """
    newest_first = [F.col(c).desc_nulls_last() for c in ORDER_COLUMNS]
    best = [p.orderBy(*newest_first).limit(rows) for p in parts]
    whole = best[0]
    for more in best[1:]:
        whole = whole.unionByName(more)
    return whole.orderBy(*newest_first).limit(rows)


def live_figures(state: DataFrame) -> DataFrame:
    """Live rows with their first and last event time, in milliseconds, as one row."""
    live = state.where(F.col("op_type") != DELETE)
    return live.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.min("source_ts_ms").alias("earliest_ms"),
        F.max("source_ts_ms").alias("latest_ms"),
    )


def figure_changes(staged: DataFrame) -> DataFrame:
    """What a merge changes in :func:`live_figures`, as one row.

    ``added`` rows; the extremes of the new live rows; and the extremes of the live rows they replaced, after
    which a stored extreme may be gone.
    """
    touched = staged.where("_touched")
    now = F.col("_kept") & (F.col("op_type") != DELETE)
    return touched.agg(
        F.coalesce(F.sum(now.cast("long") - F.col("_old_live").cast("long")), F.lit(0)).alias("added"),
        F.min(F.when(now, F.col("source_ts_ms"))).alias("new_earliest"),
        F.max(F.when(now, F.col("source_ts_ms"))).alias("new_latest"),
        F.min(F.when(F.col("_old_live"), F.col("_old_ts_ms"))).alias("old_earliest"),
        F.max(F.when(F.col("_old_live"), F.col("_old_ts_ms"))).alias("old_latest"),
    )


def carried_extreme(stored: int | None, new: int | None, old: int | None, largest: bool) -> tuple[int | None, bool]:
    """The extreme after a merge, and whether it is sure.

    It is not if a row that had the stored extreme was replaced and no new row reaches
    it: the next one is then somewhere among the rows that the merge did not touch.
    """
    sign = 1 if largest else -1
    if stored is None or (new is not None and sign * new >= sign * stored):
        return new, True
    return stored, old is None or sign * old < sign * stored
