"""The state of one key in a stream: its newest row.

This runs in Python workers, so it is apart from what starts queries.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidelog.config import ORDER_COLUMNS
from tidelog.functions.events import DELETE


class NewestRow(StatefulProcessor):
    """Keeps the newest row of a key; a delete is forgotten ``forget_ms`` after it was processed."""

    def __init__(self, columns: list[str], state_ddl: str, forget_ms: int):
        self.columns, self.state_ddl, self.forget_ms = columns, state_ddl, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", self.state_ddl)

    def _order(self, row) -> tuple:
        # Nulls rank lowest, as in Spark's comparison of structs.
        return tuple((value is not None, value) for value in (row[c] for c in ORDER_COLUMNS))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.newest.get() if self.newest.exists() else None
        best = dict(zip(self.columns, held)) if held is not None else None
        changed = False
        for row in rows:
            if best is None or self._order(row) >= self._order(best):
                best, changed = {c: row[c] for c in self.columns}, True
        if not changed:
            return
        until = None
        if best["op_type"] == DELETE:
            until = timerValues.getCurrentProcessingTimeInMs() + self.forget_ms
            self.handle.registerTimer(until)
        self.newest.update((*best.values(), until))
        yield Row(**best)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.newest.exists():
            until = self.newest.get()[-1]
            # A key that came back, or was deleted again later, has another time or none.
            if until is not None and until <= expiredTimerInfo.getExpiryTimeInMs():
                self.newest.clear()
        return iter(())

    def close(self) -> None:
        pass
