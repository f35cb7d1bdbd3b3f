"""Replayed log records in a stream, left out with bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame


def drop_replayed(change_log: DataFrame, within: str) -> DataFrame:
    """Each log position of a stream once, if its copies come within ``within`` of event time of each other.

    The state holds the positions of that span and no more.  A record whose log time
    is more than ``within`` behind the newest one seen is late, and left out whether it is a copy or
    not: choose the span that a producer may be behind or a replay may reach back.
    Copies within one micro-batch count as well.  It needs no look into the history.
    """
    return change_log.withWatermark("timestamp", within).dropDuplicatesWithinWatermark(
        ["topic", "partition", "offset"]
    )
