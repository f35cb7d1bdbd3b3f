"""Progress of streaming queries as log lines and as rows of a table."""

from __future__ import annotations

import json
import logging
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidelog.config import TableSpec
from tidelog.functions.events import OPERATIONS, UNKNOWN

log = logging.getLogger(__name__)

_SCHEMA = (
    "query_name STRING, query_id STRING, batch_id BIGINT, input_rows BIGINT, "
    "rows_per_second DOUBLE, duration_ms BIGINT, at STRING, failure STRING, observed STRING"
)

#: Name of the counts that :func:`observe_events` adds to a stream.
OBSERVED = "events"

# Rows that are written together.  A terminated query writes what is left.
_TOGETHER = 20


def observe_events(events: DataFrame, spec: TableSpec) -> DataFrame:
    """``events`` (Bronze rows) with counts that are taken as they pass, without another job.

    One count per operation (``op_INSERT`` and so on), ``unreadable`` (no operation code at
    all, as unreadable JSON leaves it), ``null_keys`` and ``events``, in the ``observedMetrics`` of each progress report.
    """
    names = sorted({*OPERATIONS.values(), UNKNOWN})
    no_key = F.lit(False)
    for key in spec.key_names:
        no_key = no_key | F.col(key).isNull()
    return events.observe(
        OBSERVED,
        F.count(F.lit(1)).alias("events"),
        *[F.count_if(F.col("op_type") == name).alias(f"op_{name}") for name in names],
        F.count_if(F.col("op").isNull()).alias("unreadable"),
        F.count_if(no_key).alias("null_keys"),
    )


def observed_counts(progress: DataFrame) -> DataFrame:
    """Sums of the observed counts over progress rows: ``measure`` and ``n``.

    A micro-batch that was repeated after a failure has one report per completed try, so
    its last one counts.
    """
    last = progress.where(F.col("observed").isNotNull()).groupBy("query_id", "batch_id").agg(F.max_by("observed", "at").alias("observed"))
    counts = last.select(F.explode(F.from_json("observed", "map<string,bigint>")).alias("measure", "n"))
    return counts.groupBy("measure").agg(F.sum("n").alias("n"))


def _observed(progress) -> str | None:
    row = (progress.observedMetrics or {}).get(OBSERVED)
    return json.dumps(row.asDict()) if row is not None else None


class ProgressLog(StreamingQueryListener):
    """Writes the progress reports of every query in the session below ``path``.

    Without ``path`` they are only logged and held until ``rows`` takes them.
    """

    def __init__(self, spark: SparkSession | None = None, path: str | None = None):
        self._spark, self._path = spark, path
        self._waiting: list[tuple] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event):
        log.info("query %s started (%s)", event.name, event.id)

    def onQueryProgress(self, event):
        p = event.progress
        row = (
            p.name,
            str(p.id),
            p.batchId,
            p.numInputRows,
            float(p.processedRowsPerSecond or 0.0),
            int(p.durationMs.get("triggerExecution", 0)),
            p.timestamp,
            None,
            _observed(p),
        )
        log.info("query %s batch %s: %s rows, %.1f rows/s, %s ms", row[0], *row[2:6])
        self._add(row, flush=False)

    def onQueryTerminated(self, event):
        if event.exception:
            log.error("query %s failed: %s", event.id, event.exception)
            self._add((None, str(event.id), None, None, None, None, None, event.exception, None), flush=True)
        else:
            self.flush()

    def _add(self, row: tuple, flush: bool) -> None:
        with self._lock:
            self._waiting.append(row)
            full = flush or len(self._waiting) >= _TOGETHER
        if full:
            self.flush()

    def flush(self) -> None:
        """Append the waiting rows to the table."""
        if not self._path:
            return
        with self._lock:
            rows, self._waiting = self._waiting, []
        if rows:
            frame = self._spark.createDataFrame(rows, _SCHEMA)
            frame.coalesce(1).write.mode("append").parquet(self._path)

    def settle(self) -> None:
        """Wait until Spark has delivered the reports so far, and write them."""
        self._spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.flush()

    def rows(self) -> list[tuple]:
        """Rows that are not in the table yet."""
        with self._lock:
            return list(self._waiting)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), _SCHEMA)


_WATCHED: dict[tuple[int, str], ProgressLog] = {}


def watch_progress(spark: SparkSession, path: str) -> ProgressLog:
    """The session's listener for ``path``; attached once."""
    key = (id(spark), path)
    if key not in _WATCHED:
        _WATCHED[key] = ProgressLog(spark, path)
        spark.streams.addListener(_WATCHED[key])
    return _WATCHED[key]
