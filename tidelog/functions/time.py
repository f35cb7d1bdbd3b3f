"""Event-time expressions over epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY_MS = 86_400_000
# Milliseconds of 0001-01-01T00:00 and of the last instant of 9999-12-31, in UTC.
_MIN_MS = -62_135_596_800_000
_MAX_MS = 253_402_300_799_999


def _in_calendar(ms: Column, value: Column) -> Column:
    # A garbage clock value must not fail the job on overflow under ANSI mode.
    return F.when(ms.between(F.lit(_MIN_MS), F.lit(_MAX_MS)), value)


def event_time(ms: Column) -> Column:
    """Epoch milliseconds as a timestamp; null outside years 1 to 9999."""
    return _in_calendar(ms, F.timestamp_millis(ms))


def event_date(ms: Column) -> Column:
    """UTC calendar date of epoch milliseconds, whatever the session time zone."""
    day = ((ms - F.pmod(ms, F.lit(_DAY_MS))) / F.lit(_DAY_MS)).cast("int")
    return _in_calendar(ms, F.date_from_unix_date(day))
