"""Silver in partitions of the key's hash, where a merge touches only the partitions it changes.

The table is a Parquet folder with a partition column computed from the key.  A merge reads the
partitions that hold a changed key, joins them with the changes and *stages* the result as a
committed write of its own; then a dynamic partition overwrite puts the staged partitions in
place of the old ones.  All others are neither read nor written.

A batch counts once its mark is there.  What is staged is complete, so a merge that broke off while
it replaced partitions is finished from there, by the next merge or :meth:`KeyedTable.recover`.
Staged rows also hold what they replaced, from which Gold follows without reading Silver.

One writer at a time.  A reader that runs while partitions are replaced may see some of them new
and others old, or miss the one being swapped: read between merges, or read the versions of
:class:`tidelog.sinks.Lake`, which never change.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import schemas
from tidelog.config import TableSpec
from tidelog.functions.events import DELETE
from tidelog.operators.merge import MODES, next_row
from tidelog.sinks.files import Folders

PART = "_part"

# Both sides of the merge are dealt by partition, which the key alone decides.
_JOIN_BY_PART = "spark.sql.requireAllClusterKeysForCoPartition"

# Merges that hold the setting, and what it was before the first; tables of one session may merge at once.
_lock = threading.Lock()
_held: dict[SparkSession, tuple[int, str]] = {}


@contextmanager
def _joins_by_part(spark: SparkSession) -> Iterator[None]:
    """The session's setting, put back when the last of the merges that hold it is done."""
    with _lock:
        holders, known = _held.get(spark) or (0, spark.conf.get(_JOIN_BY_PART))
        spark.conf.set(_JOIN_BY_PART, "false")
        _held[spark] = holders + 1, known
    try:
        yield
    finally:
        with _lock:
            holders, known = _held.pop(spark)
            if holders > 1:
                _held[spark] = holders - 1, known
            else:
                spark.conf.set(_JOIN_BY_PART, known)


class KeyedTable:
    """Newest event per key (deletes included) of one captured table below ``root``.

    ``parts`` is the number of partitions of a new table; an existing one keeps its own.  Size it
    so that a partition fits a task (a few hundred MB).  A merge of few keys costs a share of
    about keys / ``parts`` of the table, at most all of it.
    """

    def __init__(self, spark: SparkSession, root: str, spec: TableSpec, parts: int = 64):
        if parts < 1:
            raise ValueError("at least one partition is needed")
        self.spark, self.spec = spark, spec
        self.folders = Folders(spark, root)
        known = [n for n in self.folders.names("") if n.startswith("by_key_")]
        self.parts = int(known[0].rpartition("_")[2]) if known else parts
        self._data = f"by_key_{self.parts}"

    # -- Reading ---------------------------------------------------------------

    def version(self) -> int:
        """Newest batch that is merged, -1 if there is none."""
        return max(map(int, self.folders.names("merged")), default=-1)

    def read(self, parts: list[int] | None = None) -> DataFrame:
        """Rows with their partition number; of some partitions only if ``parts`` is given."""
        schema = schemas.state(self.spec).add(PART, T.IntegerType())
        if not self.folders.names(self._data):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(self.folders.at(self._data))
        return rows if parts is None else rows.where(F.col(PART).isin(parts))

    def files(self) -> dict[int, list[str]]:
        """Names of the data files of every partition."""
        found = [n for n in self.folders.names(self._data) if n.startswith(f"{PART}=")]
        return {
            int(n.partition("=")[2]): [f for f in self.folders.names(self._data, n) if f.endswith(".parquet")]
            for n in found
        }

    # -- Merging ---------------------------------------------------------------

    def merge(self, changes: DataFrame, batch: int, mode: str = "ordered") -> None:
        """Merge ``changes`` (one row per key) as batch number ``batch``; a batch merged before changes nothing."""
        self.recover()
        if batch > self.version():
            self.stage(changes, batch, mode)
            self.replace(batch)

    def stage(self, changes: DataFrame, batch: int, mode: str = "ordered") -> None:
        """Write the next content of every touched partition beside the table, unless it is there."""
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
        if self.folders.is_done("staged", str(batch)):
            return
        columns = schemas.state(self.spec).names
        keyed = changes.withColumn(PART, self._part_of()).select(PART, *columns)
        # At most one row per partition of the table.
        touched = sorted(r[0] for r in keyed.select(PART).distinct().collect())
        # The session's own number: with fewer the join would deal both sides out anew, by key.
        shuffles = self._shuffles()
        old = self.read(touched).select(PART, *self.spec.key_names, F.struct(*columns).alias("_old"))
        new = keyed.select(PART, *self.spec.key_names, F.struct(*columns).alias("_new"))
        joined = old.repartition(shuffles, PART).join(
            new.repartition(shuffles, PART).hint("merge"), [PART, *self.spec.key_names], "full_outer"
        )
        row = next_row(mode)
        staged = joined.select(PART, row.alias("_row"), F.col("_old"), F.col("_new").isNotNull().alias("_touched")).select(
            PART,
            "_touched",
            F.col("_row").isNotNull().alias("_kept"),
            *(self._domain_of(f"_{side}").alias(f"_{side}_domain") for side in ("old", "row") if self.spec.domain_column),
            F.coalesce(F.col("_old.op_type") != DELETE, F.lit(False)).alias("_old_live"),
            F.col("_old.source_ts_ms").alias("_old_ts_ms"),
            *[F.col(f"_row.{c}").alias(c) for c in columns],
        )
        with _joins_by_part(self.spark):
            path = self.folders.at("staged", str(batch))
            staged.write.mode("overwrite").partitionBy(PART).parquet(path)

    def staged(self, batch: int) -> DataFrame | None:
        """What :meth:`stage` wrote; None if no key changed."""
        if not any(n.startswith(f"{PART}=") for n in self.folders.names("staged", str(batch))):
            return None
        return self.spark.read.parquet(self.folders.at("staged", str(batch)))

    def replace(self, batch: int) -> None:
        """Put the staged partitions of a batch in place and mark it as merged."""
        staged = self.staged(batch)
        if staged is not None:
            columns = schemas.state(self.spec).names
            path = self.folders.at(self._data)
            kept = staged.where("_kept").select(*columns, PART)
            # Staged files hold one partition each, so this is no shuffle.
            kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)
            # An overwrite leaves partitions alone that have no rows any more.
            there = {n for n in self.folders.names("staged", str(batch)) if n.startswith(f"{PART}=")}
            filled = {f"{PART}={r[0]}" for r in kept.select(PART).distinct().collect()}
            for name in sorted(there - filled):
                self.folders.drop(self._data, name)
        self.folders.make("merged", f"{batch:012d}")
        for name in self.folders.names("staged"):
            if int(name) < batch:
                self.folders.drop("staged", name)
        for name in self.folders.names("merged"):
            if int(name) < batch:
                self.folders.drop("merged", name)

    def pending(self) -> int | None:
        """Batch that is staged and not yet merged, if there is one."""
        done = self.version()
        open_ = [int(n) for n in self.folders.names("staged") if int(n) > done and self.folders.is_done("staged", n)]
        return max(open_, default=None)

    def recover(self) -> int | None:
        """Finish a merge that broke off after staging; returns its batch."""
        batch = self.pending()
        if batch is not None:
            self.replace(batch)
        return batch

    # -- Expressions -----------------------------------------------------------

    def _part_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.spec.key_names), F.lit(self.parts)).cast("int")

    def _shuffles(self) -> int:
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _domain_of(self, side: str) -> Column:
        """The domain that a row counts for: none if it is deleted or not there."""
        return F.when(F.col(f"{side}.op_type") != DELETE, F.col(f"{side}.{self.spec.domain_column}"))
