"""Registered queries: ``(spark, sf_dir) -> DataFrame`` over whole tables.

Wall-clock columns cannot be compared with another engine.  They are left out,
or an event-time column stands in for them where a report is about them.
Timestamps leave as ``timestamp_ntz`` in UTC.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.change_log import ACCOUNTS, LOG_PARTITIONS, VISITORS, change_log, events_table, visitor_log
from tidelog import schemas
from tidelog.config import ORDER_COLUMNS
from tidelog.operators import (
    daily_changes,
    domain_counts,
    insert_if_absent,
    latest_state,
    parse_events,
    seed_users,
    to_silver,
)
from tidelog.operators.latest import state_inputs
from tidelog.plans import jobs, reports
from tidelog.plans.layers import (
    advance_daily,
    advance_gold,
    advance_keyed,
    advance_newest_events,
    advance_runs,
    advance_silver,
)
from tidelog.plans.topics import start_topics
from tidelog.session import scratch_root
from tidelog.sinks.files import Folders
from tidelog.sinks.keyed import KeyedTable
from tidelog.sinks.lake import DAILY, DOMAIN, FIGURES, NEWEST, RUNS, SILVER, Lake
from tidelog.sinks.maintenance import compact_bronze, drop_compacted
from tidelog.sources.footers import footer_figures
from tidelog.streaming import (
    changes_per_window,
    drop_replayed,
    observed_counts,
    process_batch,
    start_layers,
    start_window_counts,
    window_counts,
)
from tidelog.streaming.late import fold_tallies, late_events, start_window_tallies, window_tallies
from tidelog.streaming.latest import start_newest
from tidelog.streaming.progress import ProgressLog

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Intake of a micro-batch; a smaller log is cut into four.
_INTAKE_BYTES = 256 << 20

# Records of a file of the replayed log, about; each is written by one task.
_REPLAY_FILE_RECORDS = 250_000


def query(fn: Query) -> Query:
    """Register ``fn`` under its name, run in UTC, with portable timestamps out."""

    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _portable(fn(spark, sf_dir))

    QUERIES[fn.__name__.removeprefix("run_")] = run
    return run


def _portable(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def _bronze(spark, sf_dir, *columns: str) -> DataFrame:
    """Bronze (or some of its columns) straight from the change log.

    The log's own time stands in for the ingestion time.
    """
    wanted = list(columns) or schemas.bronze(ACCOUNTS).names
    log_time = "_ingestion_ts" in wanted
    if log_time and "kafka_timestamp" not in wanted:
        wanted.append("kafka_timestamp")
    events = parse_events(change_log(spark, sf_dir), ACCOUNTS, wanted)
    return events.withColumn("_ingestion_ts", F.col("kafka_timestamp")) if log_time else events


def _keyed_events(spark, sf_dir) -> DataFrame:
    """The Bronze columns that Silver is built from."""
    return _bronze(spark, sf_dir, *state_inputs(ACCOUNTS))


def _timed_operations(spark, sf_dir) -> DataFrame:
    """The Bronze columns that the daily tally is built from."""
    return _bronze(spark, sf_dir, "source_ts_ms", "op_type")


def _silver(spark, sf_dir, method: str = "window") -> DataFrame:
    return to_silver(latest_state(_keyed_events(spark, sf_dir), ACCOUNTS, method), ACCOUNTS)


def _no_clock(df: DataFrame) -> DataFrame:
    clocks = ("_ingestion_ts", "bronze_ingested_at", "silver_built_at", "gold_built_at")
    return df.drop(*clocks)


# -- Batch layers ---------------------------------------------------------------


@query
def bronze_flatten(spark, sf_dir):
    return _no_clock(parse_events(change_log(spark, sf_dir), ACCOUNTS))


@query
def silver_latest(spark, sf_dir):
    return _no_clock(_silver(spark, sf_dir))


@query
def silver_latest_max_by(spark, sf_dir):
    return _no_clock(_silver(spark, sf_dir, "max_by"))


@query
def gold_email_domain(spark, sf_dir):
    return _no_clock(domain_counts(_silver(spark, sf_dir), ACCOUNTS))


@query
def gold_daily_changes(spark, sf_dir):
    return _no_clock(daily_changes(_timed_operations(spark, sf_dir)))


@query
def gold_daily_incremental(spark, sf_dir):
    """Every log partition ingested on its own and added to the stored tally, apart from Silver."""
    lake = _new_lake(spark)
    for log in _by_log_partition(spark, sf_dir):
        jobs.ingest(log, lake, dedupe="none")
        advance_daily(lake)
    return _no_clock(lake.read(DAILY))


# -- Reports --------------------------------------------------------------------


@query
def op_mix(spark, sf_dir):
    return reports.op_mix(_timed_operations(spark, sf_dir))


@query
def op_counts(spark, sf_dir):
    return reports.op_counts(_bronze(spark, sf_dir, "op_type"))


@query
def daily_activity(spark, sf_dir):
    return reports.daily_activity(daily_changes(_timed_operations(spark, sf_dir)))


@query
def report_daily_30(spark, sf_dir):
    return reports.recent_days(daily_changes(_timed_operations(spark, sf_dir)))


@query
def latest_events_20(spark, sf_dir):
    columns = ["id", "op_type", "after_name", "after_email", "_ingestion_ts", *ORDER_COLUMNS]
    newest = reports.latest_events(_bronze(spark, sf_dir, *columns), ACCOUNTS)
    return newest.withColumnRenamed("_ingestion_ts", "kafka_timestamp")


@query
def sample_users_20(spark, sf_dir):
    return reports.sample_rows(_silver(spark, sf_dir), ACCOUNTS)


@query
def sample_users_10(spark, sf_dir):
    return reports.sample_rows(_silver(spark, sf_dir), ACCOUNTS, rows=10)


@query
def silver_kpis(spark, sf_dir):
    silver = _silver(spark, sf_dir).withColumn("silver_built_at", F.col("bronze_ingested_at"))
    return reports.silver_kpis(silver, ACCOUNTS)


@query
def quality_checks(spark, sf_dir):
    return reports.quality_checks(_silver(spark, sf_dir))


@query
def domain_share(spark, sf_dir):
    return reports.domain_share(domain_counts(_silver(spark, sf_dir), ACCOUNTS))


@query
def domain_share_all(spark, sf_dir):
    domains = domain_counts(_silver(spark, sf_dir), ACCOUNTS)
    return reports.domain_share(domains, rows=None, percent="pct_of_total")


@query
def layer_counts(spark, sf_dir):
    bronze, silver = _timed_operations(spark, sf_dir), _silver(spark, sf_dir)
    layers = (bronze, silver, domain_counts(silver, ACCOUNTS), daily_changes(bronze))
    return reports.layer_counts(dict(zip(ACCOUNTS.layer_tables, layers, strict=True)))


@query
def freshness(spark, sf_dir):
    """Event-time columns stand in for the three write times."""
    bronze = _bronze(spark, sf_dir, "source_ts_ms", "op_type", "_ingestion_ts")
    silver = _silver(spark, sf_dir).withColumn("silver_built_at", F.col("source_ts"))
    daily = daily_changes(bronze).withColumn(
        "gold_built_at", F.col("change_date").cast("timestamp")
    )
    return reports.freshness(bronze, silver, daily)


# -- Seed -----------------------------------------------------------------------


def _seed(spark, sf_dir) -> DataFrame:
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return seed_users(customers, "c_custkey", "c_name", "c_mktsegment")


@query
def run_seed_users(spark, sf_dir):
    return _seed(spark, sf_dir)


@query
def run_insert_if_absent(spark, sf_dir):
    """Rows from orders, many per key, into a table that holds the suppliers' keys."""
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    present = seed_users(suppliers, "s_suppkey", "s_name", "s_name")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rows = seed_users(orders, "o_custkey", "o_orderstatus", "o_orderpriority")
    return insert_if_absent(present, rows, ["id"])


# -- Merge ----------------------------------------------------------------------


def _loads_and_changes(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The history in two batches: initial loads, then everything else."""
    load = F.col("op_type").isin("SNAPSHOT", "INSERT")
    return bronze.where(load), bronze.where(~load)


def _merged_batches(spark, sf_dir, order: tuple[int, ...], mode: str) -> DataFrame:
    """The two batches committed and merged one by one, in the given order."""
    lake = _new_lake(spark)
    batches = _loads_and_changes(parse_events(change_log(spark, sf_dir), ACCOUNTS))
    for step, which in enumerate(order):
        lake.write_bronze(batches[which], lake.reserve(f"merge-{step}"))
        advance_silver(lake, mode=mode)
    state = lake.read(SILVER)
    return _no_clock(to_silver(state, ACCOUNTS))


@query
def merge_upsert_delete(spark, sf_dir):
    """Initial loads, then updates and deletes, by the reference clauses."""
    return _merged_batches(spark, sf_dir, (0, 1), "reference")


@query
def merge_ordered(spark, sf_dir):
    """Updates and deletes before the loads they follow, and once more after them."""
    return _merged_batches(spark, sf_dir, (1, 0, 1), "ordered")


def _by_key(lake: Lake) -> KeyedTable:
    return KeyedTable(lake.spark, f"{lake.root}/silver_by_key", lake.spec, parts=16)


@query
def merge_keyed_upsert_delete(spark, sf_dir):
    """The reference clauses on Silver by key: loads, then updates and deletes, in touched partitions only."""
    lake = _new_lake(spark)
    table = _by_key(lake)
    for step, batch in enumerate(_loads_and_changes(parse_events(change_log(spark, sf_dir), ACCOUNTS))):
        lake.write_bronze(batch, lake.reserve(f"merge-{step}"))
        advance_keyed(lake, table, mode="reference")
    return _no_clock(to_silver(table.read(), ACCOUNTS))


def _merged_by_key(spark, sf_dir) -> tuple[Lake, KeyedTable]:
    """The log in four parts by time of day, newest first, each merged into Silver by key."""
    lake = _new_lake(spark)
    table = _by_key(lake)
    log = change_log(spark, sf_dir)
    for part in (3, 1, 0, 2):
        jobs.ingest(log.where(F.floor(F.hour("timestamp") / 6) == part), lake, dedupe="none")
        advance_keyed(lake, table)
    return lake, table


@query
def merge_keyed_ordered(spark, sf_dir):
    return _no_clock(to_silver(_merged_by_key(spark, sf_dir)[1].read(), ACCOUNTS))


@query
def gold_domain_by_deltas(spark, sf_dir):
    """Domain counts that followed four merges by differences of old and new rows."""
    return _no_clock(_merged_by_key(spark, sf_dir)[0].read(DOMAIN))


@query
def silver_kpis_kept(spark, sf_dir):
    """KPIs that followed four merges, deletes of extreme rows included."""
    lake = _merged_by_key(spark, sf_dir)[0]
    return reports.kept_kpis(lake.read(FIGURES), lake.read(DOMAIN))


@query
def latest_events_20_kept(spark, sf_dir):
    """The newest events of each ingest met with the twenty stored ones."""
    lake = _new_lake(spark)
    for log in _by_log_partition(spark, sf_dir):
        jobs.ingest(log, lake, dedupe="none")
        advance_newest_events(lake)
    newest = lake.read(NEWEST).withColumn("_ingestion_ts", F.col("kafka_timestamp"))
    return reports.latest_events(newest, ACCOUNTS).withColumnRenamed("_ingestion_ts", "kafka_timestamp")


@query
def bronze_figures_from_footers(spark, sf_dir):
    """Row count and extremes of a history of three batches, answered by file footers."""
    lake = _new_lake(spark)
    for log in _by_log_partition(spark, sf_dir):
        jobs.ingest(log, lake, dedupe="none")
    return footer_figures(spark, lake.bronze_files(), schemas.bronze(ACCOUNTS), ["source_ts_ms", "kafka_offset"])


# -- Written tables -------------------------------------------------------------


def _scratch(spark) -> str:
    """A new folder below the shared scratch root."""
    return f"{scratch_root(spark).rstrip('/')}/tidelog-{uuid.uuid4().hex}"


def _new_lake(spark) -> Lake:
    return Lake(spark, _scratch(spark), ACCOUNTS)


def _by_log_partition(spark, sf_dir) -> list[DataFrame]:
    """The change log as one part per log partition."""
    log = change_log(spark, sf_dir)
    return [log.where(F.col("partition") == p) for p in range(LOG_PARTITIONS)]


@query
def bronze_append_idempotent(spark, sf_dir):
    """The whole change log ingested twice."""
    lake = _new_lake(spark)
    for _ in range(2):
        jobs.ingest(change_log(spark, sf_dir), lake, dedupe="exact")
    return _no_clock(lake.bronze())


@query
def bronze_append_offsets(spark, sf_dir):
    """One log partition first, then twice the whole log, by stored offsets."""
    lake = _new_lake(spark)
    whole = change_log(spark, sf_dir)
    for log in (_by_log_partition(spark, sf_dir)[1], whole, whole):
        jobs.ingest(log, lake, dedupe="offsets")
    return _no_clock(lake.bronze())


@query
def bronze_append_gaps(spark, sf_dir):
    """Every third offset, then a range with copies of each record, then the whole log."""
    lake = _new_lake(spark)
    whole = change_log(spark, sf_dir)
    upper = whole.where(F.col("offset") % 2 == 1)
    for log in (whole.where(F.col("offset") % 3 == 0), upper.union(upper), whole):
        jobs.ingest(log, lake, dedupe="exact")
    return _no_clock(lake.bronze())


@query
def stored_offset_runs(spark, sf_dir):
    """Runs of consecutive offsets per log partition, carried along over two ingests."""
    lake = _new_lake(spark)
    whole = change_log(spark, sf_dir)
    for log in (whole.where(F.col("offset") % 5 < 3), whole):
        jobs.ingest(log, lake, dedupe="exact")
    advance_runs(lake)
    return lake.read(RUNS)


@query
def ingest_empty_scan(spark, sf_dir):
    """Tables made by the first scan; an empty scan after it changes nothing."""
    lake = _new_lake(spark)
    log = change_log(spark, sf_dir)
    for scan in (log, log.where("offset < 0")):
        jobs.ingest(scan, lake, dedupe="exact")
    return _no_clock(lake.bronze())


@query
def silver_two_writers(spark, sf_dir):
    """The first writer commits after the second one has committed and merged."""
    root = _scratch(spark)
    first, second = (Lake(spark, root, ACCOUNTS) for _ in range(2))
    early, late, rest = _by_log_partition(spark, sf_dir)
    number = first.reserve("first-0")
    jobs.ingest(late, second, dedupe="none")
    jobs.transform(second)
    first.write_bronze(parse_events(early, ACCOUNTS), number)
    jobs.ingest(rest, second, dedupe="none")
    for lake in (first, second):
        jobs.transform(lake)
    return _no_clock(to_silver(first.read(SILVER), ACCOUNTS))


@query
def run_run_all_layers(spark, sf_dir):
    """The whole chain twice over the same log; rows of every layer."""
    lake = _new_lake(spark)
    for _ in range(2):
        counts = jobs.run_all(lambda: change_log(spark, sf_dir), lake)["verify"]
    return spark.createDataFrame(sorted(counts.items()), "layer string, rows bigint")


@query
def transform_full(spark, sf_dir):
    """Incremental tables of a part, then everything rebuilt from the whole history."""
    lake = _new_lake(spark)
    for log, full in ((_by_log_partition(spark, sf_dir)[0], False), (change_log(spark, sf_dir), True)):
        jobs.ingest(log, lake)
        jobs.transform(lake, full=full)
    return _no_clock(to_silver(lake.read(SILVER), ACCOUNTS))


def _report(spark, sf_dir, section: str, title: str) -> DataFrame:
    """One report of the runner, on registered tables."""
    lake = _new_lake(spark)
    jobs.ingest(change_log(spark, sf_dir), lake, dedupe="none")
    jobs.transform(lake)
    lake.register()
    return reports.run(spark, ACCOUNTS, section, lake.prefix)[title]


@query
def report_section_bronze(spark, sf_dir):
    return _report(spark, sf_dir, "bronze", "operation mix")


@query
def report_section_silver(spark, sf_dir):
    return _report(spark, sf_dir, "silver", "data quality")


@query
def report_section_gold(spark, sf_dir):
    return _report(spark, sf_dir, "gold", "top 20 domains")


@query
def seed_table_twice(spark, sf_dir):
    """The same rows seeded twice, the second time without the catalog's entry."""
    table, where = f"default.seeded_{uuid.uuid4().hex}", _scratch(spark)
    for _ in range(2):
        jobs.seed(spark, _seed(spark, sf_dir), table, ["id"], where)
        spark.sql(f"DROP TABLE {table}")
    return spark.read.parquet(where)


@query
def silver_incremental(spark, sf_dir):
    """Three ingests, each merged into the stored Silver."""
    lake = _new_lake(spark)
    for log in _by_log_partition(spark, sf_dir):
        jobs.ingest(log, lake, dedupe="none")
        advance_silver(lake)
    return _no_clock(to_silver(lake.read(SILVER), ACCOUNTS))


@query
def run_compact_bronze(spark, sf_dir):
    """Content after compaction equals the content before."""
    lake = _new_lake(spark)
    for log in _by_log_partition(spark, sf_dir):
        jobs.ingest(log, lake, dedupe="none")
    advance_silver(lake)
    advance_gold(lake)
    compact_bronze(lake)
    drop_compacted(lake)
    return _no_clock(lake.bronze())


# -- Streaming ------------------------------------------------------------------


def _stage(log: DataFrame, folder: str) -> int:
    """The log as files of bounded size; returns the bytes of a micro-batch.

    Micro-batches are of a fixed size, so a longer log has more of them.
    """
    log.write.option("maxRecordsPerFile", 25_000).mode("append").parquet(f"{folder}/log")
    size = Folders(log.sparkSession, folder).size("log")
    return min(_INTAKE_BYTES, -(-size // 4))


def _run_stream(spark, folder: str, lake: Lake, intake: int, **options) -> None:
    reader = spark.readStream.schema(schemas.CHANGE_LOG).option("maxBytesPerTrigger", intake)
    query = start_layers(
        reader.parquet(f"{folder}/log"), lake, f"{folder}/checkpoint", trigger_seconds=None, **options
    )
    query.awaitTermination()


def _streamed(spark, sf_dir, **options) -> Lake:
    folder = _scratch(spark)
    lake = Lake(spark, f"{folder}/lake", ACCOUNTS)
    intake = _stage(change_log(spark, sf_dir), folder)
    _run_stream(spark, folder, lake, intake, **options)
    return lake


@query
def stream_restart(spark, sf_dir):
    """A batch that broke off after Bronze, a stop, and a restart on a longer log."""
    folder = _scratch(spark)
    lake = Lake(spark, f"{folder}/lake", ACCOUNTS)
    broken, *parts = _by_log_partition(spark, sf_dir)
    process_batch(broken, "broken-0", lake, merge=False)
    for part in parts:
        intake = _stage(part, folder)
        _run_stream(spark, folder, lake, intake)
    process_batch(broken, "broken-0", lake)
    return _no_clock(to_silver(lake.read(SILVER), ACCOUNTS))


@query
def stream_bronze(spark, sf_dir):
    return _no_clock(_streamed(spark, sf_dir, bronze_only=True).bronze())


@query
def stream_silver(spark, sf_dir):
    return _no_clock(to_silver(_streamed(spark, sf_dir).read(SILVER), ACCOUNTS))


@query
def stream_gold(spark, sf_dir):
    return _no_clock(_streamed(spark, sf_dir).read(DAILY))


@query
def stream_gold_domain(spark, sf_dir):
    return _no_clock(_streamed(spark, sf_dir).read(DOMAIN))


@query
def stream_keyed_silver(spark, sf_dir):
    """The layers with Silver by key."""
    folder = _scratch(spark)
    lake = Lake(spark, f"{folder}/lake", ACCOUNTS)
    table = _by_key(lake)
    _run_stream(spark, folder, lake, _stage(change_log(spark, sf_dir), folder), table=table)
    return _no_clock(to_silver(table.read(), ACCOUNTS))


def _stage_replay(log: DataFrame, folder: str) -> tuple[int, str]:
    """The log in order of time in three steps, its newest third again as a fourth; files of a step, span of the replay.

    A step has two files of the log, or as many times two as its records need.
    """
    ends = log.agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last"), F.count(F.lit(1)).alias("n")).first()
    third = ends["last"] - (ends["last"] - ends["first"]) / 3
    within = f"{int((ends['last'] - third).total_seconds()) + 3600} seconds"
    files, clock = Folders(log.sparkSession, folder), 1_600_000_000_000
    step = 2 * max(1, -(-ends["n"] // (6 * _REPLAY_FILE_RECORDS)))
    files.make("log")
    for name, parts in (("whole", 3 * step), ("again", step)):
        if name == "again":  # from the files, so that the records are not derived once more
            stored = log.sparkSession.read.schema(schemas.CHANGE_LOG).parquet(f"{folder}/log")
            log = stored.where(F.col("timestamp") >= F.lit(third))
        log.repartitionByRange(parts, "timestamp").write.parquet(f"{folder}/{name}")
        for part in (n for n in files.names(name) if n.startswith("part-")):
            clock += 1000  # a file stream reads the oldest file first
            files.set_time(clock, name, part)
            files.move((name, part), ("log", part))
    return step, within


@query
def stream_replayed_log(spark, sf_dir):
    """The log in order of time, its newest third delivered again at the end; each position counts once."""
    folder = _scratch(spark)
    lake = Lake(spark, f"{folder}/lake", ACCOUNTS)
    step, within = _stage_replay(change_log(spark, sf_dir), folder)
    reader = spark.readStream.schema(schemas.CHANGE_LOG).option("maxFilesPerTrigger", step)
    start_layers(
        drop_replayed(reader.parquet(f"{folder}/log"), within),
        lake,
        f"{folder}/checkpoint",
        trigger_seconds=None,
        bronze_only=True,
    ).awaitTermination()
    return _no_clock(lake.bronze())


def _newest(spark, sf_dir, **options) -> DataFrame:
    """Silver from the stream's own state."""
    folder = _scratch(spark)
    table = KeyedTable(spark, f"{folder}/silver", ACCOUNTS, parts=16)
    intake = _stage(change_log(spark, sf_dir), folder)
    reader = spark.readStream.schema(schemas.CHANGE_LOG).option("maxBytesPerTrigger", intake)
    start_newest(
        reader.parquet(f"{folder}/log"), table, f"{folder}/checkpoint", trigger_seconds=None, **options
    ).awaitTermination()
    return _no_clock(to_silver(table.read(), ACCOUNTS))


@query
def stream_newest_rows(spark, sf_dir):
    return _newest(spark, sf_dir)


@query
def stream_newest_rows_expiring(spark, sf_dir):
    """With timers that would forget a delete after a day."""
    return _newest(spark, sf_dir, forget_deletes_ms=86_400_000)


def _topics(spark, sf_dir) -> dict[str, Lake]:
    """Two topics from one stream, dealt out in each micro-batch."""
    folder = _scratch(spark)
    lakes = {spec.topic: Lake(spark, f"{folder}/{spec.name}", spec) for spec in (ACCOUNTS, VISITORS)}
    log = change_log(spark, sf_dir)
    intake = _stage(log.unionByName(visitor_log(log)), folder)
    reader = spark.readStream.schema(schemas.CHANGE_LOG).option("maxBytesPerTrigger", intake)
    tables = {VISITORS.topic: _by_key(lakes[VISITORS.topic])}
    start_topics(
        reader.parquet(f"{folder}/log"),
        lakes,
        f"{folder}/checkpoint",
        f"{folder}/staging",
        tables=tables,
        trigger_seconds=None,
    ).awaitTermination()
    return lakes


@query
def stream_topics_bronze(spark, sf_dir):
    """The history of both topics."""
    first, second = _topics(spark, sf_dir).values()
    return _no_clock(first.bronze().unionByName(second.bronze()))


@query
def stream_topics_domains(spark, sf_dir):
    """The domain tables of both topics: one counted from Silver's versions, the other by differences."""
    lakes = _topics(spark, sf_dir)
    parts = [lake.read(DOMAIN).withColumn("topic", F.lit(topic)) for topic, lake in lakes.items()]
    return _no_clock(parts[0].unionByName(parts[1]))


@query
def stream_observed_ops(spark, sf_dir):
    """Events per operation as the stream's progress reports counted them."""
    folder = _scratch(spark)
    lake = Lake(spark, f"{folder}/lake", ACCOUNTS)
    reports_at = f"{folder}/progress"
    listener = ProgressLog(spark, reports_at)
    spark.streams.addListener(listener)
    try:
        _run_stream(spark, folder, lake, _stage(change_log(spark, sf_dir), folder), bronze_only=True, metrics=True)
        listener.settle()
    finally:
        spark.streams.removeListener(listener)
    counts = observed_counts(spark.read.parquet(reports_at))
    named = counts.where(F.col("measure").startswith("op_") & (F.col("n") > 0))
    return named.select(F.substring("measure", 4, 100).alias("op_type"), F.col("n").alias("event_count"))


def _window_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("ts").cast("timestamp").alias("source_ts"), F.col("event_type").alias("op_type")
    )


@query
def window_changes_5m(spark, sf_dir):
    return changes_per_window(_window_events(events_table(spark, sf_dir)))


@query
def stream_window_changes_5m(spark, sf_dir):
    """The events as files in the order of their time, a few in each micro-batch."""
    folder = _scratch(spark)
    events = _window_events(events_table(spark, sf_dir))
    events.repartitionByRange(8, "source_ts").write.parquet(f"{folder}/events")
    files = Folders(spark, folder)
    parts = [name for name in files.names("events") if name.startswith("part-")]
    for k, name in enumerate(parts):  # a file stream reads the oldest file first
        files.set_time(1_600_000_000_000 + 1000 * k, "events", name)
    reader = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2)
    start_window_counts(
        reader.parquet(f"{folder}/events"),
        f"{folder}/windows",
        f"{folder}/checkpoint",
        trigger_seconds=None,
    ).awaitTermination()
    return window_counts(spark, f"{folder}/windows")


@query
def stream_window_late_5m(spark, sf_dir):
    """Events in no order of time, so that many come late: the counts and the late rows together, per window."""
    folder = _scratch(spark)
    events = _window_events(events_table(spark, sf_dir))
    events.repartition(6, F.xxhash64("source_ts", "op_type")).write.parquet(f"{folder}/events")
    reader = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    where = f"{folder}/windows"
    start_window_tallies(
        reader.parquet(f"{folder}/events"), where, f"{folder}/checkpoint", trigger_seconds=None
    ).awaitTermination()
    fold_tallies(spark, where)
    late = changes_per_window(late_events(spark, where), watermark=None)
    both = window_tallies(spark, where).drop("final").unionByName(late)
    return both.groupBy("window_start", "window_end", "op_type").agg(F.sum("event_count").alias("event_count"))
