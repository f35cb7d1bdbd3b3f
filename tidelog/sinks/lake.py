"""Layer tables as Parquet folders, written so that every step can be repeated.

Bronze grows by one folder per committed batch.  Silver and Gold are versions,
each numbered by the last Bronze batch it covers and computed only from an older
version plus the batches after it.  A folder counts once Spark has committed the
write into it, so a step that dies halfway is invisible and a repeated step
either finds its result or writes the same one again.  A batch that another writer
has overtaken is numbered anew before it can be seen, so no derived table leaves it out.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.config import TableSpec
from tidelog.sinks.files import Folders

SILVER, DOMAIN, DAILY, MARKS, RUNS = "silver", "gold_domain", "gold_daily", "log_marks", "log_runs"
FIGURES, NEWEST = "silver_figures", "newest_events"
VERSIONED = (SILVER, DOMAIN, DAILY, MARKS, RUNS, FIGURES, NEWEST)

# A lock older than this is a dead writer's.
_LOCK_SECONDS = 60

# Partitions registered per ALTER TABLE statement.
_PARTITIONS_PER_STATEMENT = 500


class Lake:
    """Bronze, Silver and Gold of one captured table below one folder.

    ``buckets`` is the number of key buckets of Silver, by default that of the
    newest version, and for a new lake the session's shuffle partitions.  Keep it
    the same over the life of a lake, so that a merge shuffles only the changes;
    size it so that one bucket of Silver fits a task (a few hundred MB).
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        spec: TableSpec,
        *,
        buckets: int | None = None,
        prefix: str = "",
    ):
        self.spark = spark
        self.spec = spec
        self.folders = Folders(spark, root)
        self.prefix = prefix
        self._tag = hashlib.md5(self.folders.root.encode()).hexdigest()[:10]
        stored = self.version(SILVER)
        self.buckets = buckets or (
            self._buckets_of(stored)
            if stored >= 0
            else int(spark.conf.get("spark.sql.shuffle.partitions"))
        )

    @property
    def root(self) -> str:
        return self.folders.root

    # -- Bronze ----------------------------------------------------------------

    def reserve(self, owner: str) -> int:
        """Batch number for ``owner``.

        A streaming micro-batch names itself by query and batch id, so its retry
        gets the number of the first try.  Only if that try never committed and
        a later batch did, a new number is given: Silver may be past the old one.
        """
        taken = [name.partition("--") for name in self.folders.names("batch_owners")]
        newest = self.last_batch()
        mine = [int(number) for number, _, who in taken if who == owner]
        if mine and (max(mine) > newest or self._is_committed(max(mine))):
            return max(mine)
        return self._claim(max([newest, *(int(n) for n, _, _ in taken)], default=-1) + 1, owner)

    def _claim(self, number: int, owner: str) -> int:
        """The first free number from ``number`` on, for ``owner`` alone."""
        while not self.folders.claim("batch_claims", f"{number:012d}"):
            number += 1
        self.folders.make("batch_owners", f"{number:012d}--{owner}")
        return number

    def forget_owners(self) -> int:
        """Drop batch reservations that can no longer be retried.

        A query only ever repeats its newest batch, so that one is kept.
        """
        names = [name.partition("--") for name in self.folders.names("batch_owners")]
        newest: dict[str, str] = {}
        for number, _, owner in names:  # names are sorted by number
            newest[owner.rpartition("-")[0]] = number
        stale = [(n, who) for n, _, who in names if newest[who.rpartition("-")[0]] != n]
        for number, owner in stale:
            self.folders.drop("batch_owners", f"{number}--{owner}")
        # New numbers are above the newest batch, so older claims are never asked for again.
        newest_batch = self.last_batch()
        for name in self.folders.names("batch_claims"):
            if int(name) < newest_batch:
                self.folders.drop("batch_claims", name)
        return len(stale)

    def _is_committed(self, number: int) -> bool:
        done = self.folders.is_done("bronze", f"batch={number}")
        return done or number <= self._compacted_through()

    def write_bronze(self, events: DataFrame, number: int) -> int | None:
        """Append one batch; returns its rows, or None if it was there already.

        The rows are written out of sight and put in place by one rename.  Only one writer at a
        time does that, and gives the batch a number above every committed one: whoever has listed
        the history before sees it in none of the numbers listed, and whoever lists it later sees all of it.
        So a derived table can neither leave the batch out nor count it twice.  That needs
        a file system whose rename and exclusive create are atomic (HDFS is one, a bare object store is not).
        """
        if self._is_committed(number):
            return None
        pending = f"{number:012d}-{uuid.uuid4().hex}"
        path = self.folders.at("bronze_pending", pending)
        rows = _counted(events, lambda df: df.write.parquet(path))
        with self._alone():
            newest = max(self.last_batch(), *(self.version(table) for table in VERSIONED))
            if number <= newest:
                names = [name.partition("--") for name in self.folders.names("batch_owners")]
                owner = next((who for n, _, who in names if int(n) == number), "late")
                number = self._claim(newest + 1, owner)
            self.folders.make("bronze")
            self.folders.move(("bronze_pending", pending), ("bronze", f"batch={number}"))
        return rows

    @contextmanager
    def _alone(self) -> Iterator[None]:
        """Hold the lake's lock, for a moment: no Spark job runs under it."""
        waited = 0.0
        while not self.folders.claim("bronze_lock"):
            age = self.folders.age_seconds("bronze_lock")
            if age is not None and age > _LOCK_SECONDS:
                # Its holder died between two renames.
                self.folders.drop("bronze_lock")
            elif waited > 2 * _LOCK_SECONDS:
                raise TimeoutError(f"another writer holds {self.folders.at('bronze_lock')}")
            else:
                time.sleep(0.2)
                waited += 0.2
        try:
            yield
        finally:
            self.folders.drop("bronze_lock")

    def bronze(self, after: int = -1, through: int | None = None) -> DataFrame:
        """History in batches ``after < n <= through``."""
        paths = [
            path
            for number, path in sorted(self._units().items())
            if number > after and (through is None or number <= through)
        ]
        return self._read(paths, schemas.bronze(self.spec))

    def bronze_files(self) -> list[str]:
        """Folders of the committed pieces of the history."""
        return [path for _, path in sorted(self._units().items())]

    def last_batch(self) -> int:
        """Number of the newest committed batch, -1 if there is none."""
        return max(self._units(), default=-1)

    def batches(self, after: int = -1) -> list[int]:
        """Numbers of the committed batches after ``after``, in order."""
        return sorted(n for n in self._units() if n > after)

    def waiting_share(self) -> float:
        """Bytes of history that Silver does not cover, as a share of Silver's own; infinite without a Silver."""
        done = self.version(SILVER)
        if done < 0:
            return float("inf")
        waiting = sum(self.folders.size("bronze", f"batch={n}") for n in self.batches(after=done))
        return waiting / max(1, self.folders.size(SILVER, self._folder(SILVER, done)))

    def loose_batches(self, through: int) -> tuple[int, list[int]]:
        """First batch after the last compaction, and the committed ones from there."""
        first = self._compacted_through() + 1
        names = self.folders.names("bronze")
        found = [int(n.partition("=")[2]) for n in names if self.folders.is_done("bronze", n)]
        return first, sorted(n for n in found if first <= n <= through)

    def write_compacted(self, rows: DataFrame, first: int, last: int) -> None:
        """Write batches ``first`` to ``last`` as one piece."""
        # A number that was reserved but never written must not count as part of
        # the piece: its owner has been overtaken and gets a new one.
        for name in self.folders.names("batch_owners"):
            number = int(name.partition("--")[0])
            if first <= number <= last and not self._is_committed(number):
                self.folders.drop("batch_owners", name)
        path = self.folders.at("bronze_compact", f"{first}-{last}")
        rows.write.mode("overwrite").parquet(path)

    def drop_replaced(self) -> list[int]:
        """Delete loose batches that a committed compacted piece holds."""
        covered = self._compacted_through()
        numbers = [int(n.partition("=")[2]) for n in self.folders.names("bronze")]
        replaced = sorted(n for n in numbers if n <= covered)
        for number in replaced:
            self.folders.drop("bronze", f"batch={number}")
        return replaced

    def drop_unfinished(self) -> list[str]:
        """Delete folders of writes that were never committed."""
        dropped = []
        for parent in ("bronze", "bronze_compact", "bronze_pending", *VERSIONED):
            for name in self.folders.names(parent):
                # What is pending was never put in place, whether its write was committed or not.
                if parent == "bronze_pending" or not self.folders.is_done(parent, name):
                    self.folders.drop(parent, name)
                    dropped.append(f"{parent}/{name}")
        return dropped

    def _compacted_through(self) -> int:
        names = self.folders.names("bronze_compact")
        done = [n for n in names if self.folders.is_done("bronze_compact", n)]
        return max((int(n.partition("-")[2]) for n in done), default=-1)

    def _units(self) -> dict[int, str]:
        """Committed pieces of the history by their last batch number."""
        units, covered = {}, self._compacted_through()
        for name in self.folders.names("bronze_compact"):
            if self.folders.is_done("bronze_compact", name):
                units[int(name.partition("-")[2])] = self.folders.at("bronze_compact", name)
        for name in self.folders.names("bronze"):
            number = int(name.partition("=")[2])
            if number > covered and self.folders.is_done("bronze", name):
                units[number] = self.folders.at("bronze", name)
        return units

    # -- Versions --------------------------------------------------------------

    def version(self, table: str, below: int | None = None) -> int:
        """Newest committed version (older than ``below``), -1 if there is none."""
        found = (v for v, _, _ in self._versions(table))
        return max((v for v in found if below is None or v < below), default=-1)

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """A version of a Silver or Gold table; the newest by default.

        Silver comes with its deleted keys and ordering columns.
        """
        version = self.version(table) if version is None else version
        schema = self._schema(table)
        if version < 0:
            return self.spark.createDataFrame([], schema)
        name = self._folder(table, version)
        if table == SILVER:
            return self.spark.table(self._bucketed_table(name))
        return self._read([self.folders.at(table, name)], schema)

    def publish(
        self,
        table: str,
        rows: DataFrame,
        version: int,
        *,
        merged_onto: int | None = None,
        replace: bool = False,
    ) -> int | None:
        """Write one version; returns its rows, or None if it was there already.

        ``replace`` writes the version anew beside the old one, which readers
        leave once the new one is committed.  ``merged_onto`` names the Silver
        version that ``rows`` was joined from: its buckets are already in place.
        """
        same = [r for v, r, _ in self._versions(table) if v == version]
        if same and not replace:
            return None
        revision = max(same, default=-1) + 1
        rows = rows.select(*self._schema(table).names)
        if table != SILVER:
            path = self.folders.at(table, f"version={version}-{revision}")
            return _counted(rows, lambda df: df.write.mode("overwrite").parquet(path))

        # One file per bucket: each bucket is written by the one task that holds
        # it.  A merge leaves every bucket in the task that read it.
        target = self._bucketed_table(f"version={version}-{revision}-{self.buckets}")
        if merged_onto is None or self._buckets_of(merged_onto) != self.buckets:
            rows = rows.repartition(self.buckets, *self.spec.key_names)
        return _counted(rows, lambda df: df.write.mode("overwrite").insertInto(target))

    def retire(self, table: str, keep: int) -> list[int]:
        """Drop all but the ``keep`` newest versions."""
        if keep < 1:
            raise ValueError("at least one version must stay")
        old = self._versions(table)[:-keep]
        for _, _, name in old:
            if table == SILVER:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._bucketed_name(name)}")
            self.folders.drop(table, name)
        return [v for v, _, _ in old]

    def _versions(self, table: str) -> list[tuple[int, int, str]]:
        """Committed ``(version, revision, folder)``, oldest first."""
        if table not in VERSIONED:
            raise ValueError(f"table must be one of {VERSIONED}, not {table!r}")
        found = []
        for name in self.folders.names(table):
            if self.folders.is_done(table, name):
                version, revision, *_ = name.partition("=")[2].split("-")
                found.append((int(version), int(revision), name))
        return sorted(found)

    def _folder(self, table: str, version: int) -> str:
        return [name for v, _, name in self._versions(table) if v == version][-1]

    def _buckets_of(self, version: int) -> int:
        return int(self._folder(SILVER, version).rpartition("-")[2])

    def _schema(self, table: str):
        return {
            SILVER: lambda: schemas.state(self.spec),
            DOMAIN: schemas.gold_domain,
            DAILY: schemas.gold_daily,
            MARKS: schemas.log_marks,
            RUNS: schemas.log_runs,
            FIGURES: schemas.silver_figures,
            NEWEST: lambda: schemas.bronze(self.spec),
        }[table]()

    # -- SQL names -------------------------------------------------------------

    def register(self) -> list[str]:
        """Put the newest tables under their SQL names and return those names."""
        for layer in ("bronze", "silver", "gold"):
            self._database(f"{self.prefix}{layer}")
        names = []
        if self._units():
            names.append(self._register_bronze())
        for table, sql_name in (
            (SILVER, self.spec.silver_table),
            (DOMAIN, self.spec.domain_table),
            (DAILY, self.spec.daily_table),
        ):
            version = self.version(table)
            if version < 0 or (table == DOMAIN and not self.spec.domain_column):
                continue
            folder = self.folders.at(table, self._folder(table, version))
            if table == SILVER:
                columns, live = schemas.silver(self.spec).names, "op_type <> 'DELETE'"
            else:
                columns, live = self._schema(table).names, "true"
            self._view(sql_name, columns, f"parquet.`{folder}`", live)
            names.append(f"{self.prefix}{sql_name}")
        return names

    def _register_bronze(self) -> str:
        """View over a table with one partition per committed piece of the history.

        Each state of the history gets its own table, and the view moves to it at
        once, so a query never sees a half-registered history.
        """
        stem = f"{self.spec.name}_{self._tag}_bronze"
        table = f"{stem}_{self.last_batch()}_{self._compacted_through() + 1}"
        columns = schemas.bronze(self.spec)
        self._database("tidelog_state")
        known = self._state_tables(f"{stem}_*")
        if table not in known:
            where = self.folders.at("bronze")
            self.spark.sql(
                f"CREATE TABLE tidelog_state.{table} ({_ddl(columns)}, _batch BIGINT) "
                f"USING parquet PARTITIONED BY (_batch) LOCATION '{where}'"
            )
            units = sorted(self._units().items())
            for start in range(0, len(units), _PARTITIONS_PER_STATEMENT):
                clauses = " ".join(
                    f"PARTITION (_batch={number}) LOCATION '{path}'"
                    for number, path in units[start : start + _PARTITIONS_PER_STATEMENT]
                )
                self.spark.sql(f"ALTER TABLE tidelog_state.{table} ADD {clauses}")
        self._view(self.spec.bronze_table, columns.names, f"tidelog_state.{table}")
        for old in known:
            if old != table:
                self.spark.sql(f"DROP TABLE IF EXISTS tidelog_state.{old}")
        return f"{self.prefix}{self.spec.bronze_table}"

    def _view(self, name: str, columns: list[str], source: str, where: str = "true") -> None:
        picked = ", ".join(f"`{c}`" for c in columns)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.prefix}{name} AS "
            f"SELECT {picked} FROM {source} WHERE {where}"
        )

    def _state_tables(self, pattern: str) -> list[str]:
        found = self.spark.sql(f"SHOW TABLES IN tidelog_state LIKE '{pattern}'")
        # A handful: one per registered state of this lake.
        return [row["tableName"] for row in found.collect()]

    def _database(self, name: str) -> None:
        where = self.folders.at("catalog", name)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{where}'")

    # -- Reading ---------------------------------------------------------------

    def _read(self, paths: list[str], schema) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _bucketed_name(self, folder: str) -> str:
        version = folder.partition("=")[2].replace("-", "_")
        return f"tidelog_state.{self.spec.name}_{self._tag}_{version}"

    def _bucketed_table(self, folder: str) -> str:
        """Catalog entry that tells Spark how the files of a version are bucketed."""
        name = self._bucketed_name(folder)
        if not self.spark.catalog.tableExists(name):
            self._database("tidelog_state")
            keys = ", ".join(f"`{k}`" for k in self.spec.key_names)
            buckets = int(folder.rpartition("-")[2])
            self.spark.sql(
                f"CREATE TABLE {name} ({_ddl(schemas.state(self.spec))}) USING parquet "
                f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS "
                f"LOCATION '{self.folders.at(SILVER, folder)}'"
            )
        return name


def _counted(rows: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write and count in one pass."""
    seen = Observation()
    write(rows.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
