import time

import pytest
from pyspark.errors import StreamingQueryException

from tidelog import USERS, schemas
from tidelog.operators import daily_changes, latest_state, parse_events, to_silver
from tidelog.plans import jobs
from tidelog.plans.layers import fresh_state
from tidelog.sinks.lake import DAILY, DOMAIN, SILVER
from tidelog.sources import stream_change_log
from tidelog.streaming import (
    ProgressLog,
    changes_per_window,
    process_batch,
    start_layers,
    start_window_counts,
    window_counts,
)
from tidelog.streaming import layers as stream_steps

CLOCKS = ("silver_built_at", "bronze_ingested_at", "gold_built_at", "_ingestion_ts")
DAY = 86_400_000


def rows(df):
    return sorted(map(tuple, df.drop(*CLOCKS).collect()), key=str)


def many_frame(log, n):
    return log.frame([log.record("c", k, DAY * 19_000 + k, name=f"name {k}", email=f"u{k}@x{k % 9}.com") for k in range(n)])


@pytest.fixture
def feed(tmp_path, spark, log):
    """Adds files to a change-log folder and streams them one file per batch."""

    class Feed:
        path = str(tmp_path / "log")
        checkpoint = str(tmp_path / "checkpoint")
        records = []

        def add(self, records):
            self.records = self.records + records
            log.frame(records).coalesce(1).write.mode("append").parquet(self.path)

        def run(self, lake, **options):
            one = {"maxFilesPerTrigger": "1"}
            stream = stream_change_log(spark, USERS, path=self.path, limits=one)
            query = start_layers(stream, lake, self.checkpoint, trigger_seconds=None, **options)
            query.awaitTermination()
            return query

        def check(self, lake):
            bronze = parse_events(log.frame(self.records), USERS)
            silver = to_silver(latest_state(bronze, USERS), USERS)
            assert rows(lake.bronze()) == rows(bronze)
            assert rows(to_silver(lake.read(SILVER), USERS)) == rows(silver)
            assert rows(lake.read(DAILY)) == rows(daily_changes(bronze))

    return Feed()


def snapshot(log, n=200):
    return [
        log.record("r", i, DAY * 19_000, name=f"USER {i}", email=f"user{i}@example.com")
        for i in range(1, n + 1)
    ]


def test_documented_acceptance(feed, lake, log):
    """Snapshot, then an update, then a delete: the documented row counts."""

    def counts():
        silver = to_silver(lake.read(SILVER), USERS)
        domains = {r.email_domain: r.user_count for r in lake.read(DOMAIN).collect()}
        return lake.bronze().count(), silver.count(), domains

    feed.add(snapshot(log))
    feed.run(lake)
    assert counts() == (200, 200, {"example.com": 200})
    (daily,) = lake.read(DAILY).collect()
    assert (daily.op_type, daily.event_count) == ("SNAPSHOT", 200)

    changed = "PENELOPE GUINESS-UPDATED"
    feed.add([log.record("u", 1, DAY * 19_001, name=changed, email="user1@example.com")])
    feed.run(lake)
    assert counts() == (201, 200, {"example.com": 200})
    assert to_silver(lake.read(SILVER), USERS).where("id = 1").first().name == changed

    feed.add([log.record("d", 200, DAY * 19_002)])
    feed.run(lake)
    assert counts() == (202, 199, {"example.com": 199})
    feed.check(lake)


def many(log, n, start=0):
    ops = "cuudr"
    return [
        log.record(ops[i % 5], i % 9, (i * 7 + start) % 40 * DAY, lsn=i, email=f"a@d{i % 3}.com")
        for i in range(n)
    ]


@pytest.mark.parametrize("merge_every", [1, 2])
def test_stream_equals_batch(feed, lake, log, merge_every):
    for start in range(4):
        feed.add(many(log, 10, start))
    feed.run(lake, merge_every=merge_every)
    assert lake.batches() == [0, 1, 2, 3]
    feed.check(lake)


@pytest.mark.parametrize("step", ["advance_silver", "advance_gold"])
def test_failed_batch_is_repeated_without_duplicates(feed, lake, log, monkeypatch, step):
    feed.add(many(log, 10))
    feed.run(lake)
    feed.add(many(log, 10, 3))

    def fail(*args, **kwargs):
        raise RuntimeError("lost executor")

    with monkeypatch.context() as patched:
        patched.setattr(stream_steps, step, fail)
        with pytest.raises(StreamingQueryException, match="lost executor"):
            feed.run(lake)
    assert lake.last_batch() == 1  # Bronze had been committed before the failure

    feed.add(many(log, 10, 5))
    feed.run(lake)
    assert lake.batches() == [0, 1, 2]
    feed.check(lake)


def test_new_checkpoint_replays_without_touching_older_batches(feed, lake, log, tmp_path):
    feed.add(many(log, 10))
    feed.run(lake)
    feed.checkpoint = str(tmp_path / "another")
    feed.run(lake)
    # Without deduplication a replay is new history; nothing was overwritten.
    assert lake.batches() == [0, 1]
    assert lake.bronze().count() == 20
    silver = to_silver(latest_state(parse_events(log.frame(feed.records), USERS), USERS), USERS)
    assert rows(to_silver(lake.read(SILVER), USERS)) == rows(silver)


@pytest.mark.parametrize("dedupe", ["exact", "offsets"])
def test_replay_can_be_deduplicated(feed, lake, log, spark, tmp_path, dedupe):
    feed.add(many(log, 10))
    feed.run(lake, dedupe=dedupe)
    feed.add(many(log, 10, 4))
    feed.checkpoint = str(tmp_path / "another")
    feed.run(lake, dedupe=dedupe, register=True)
    feed.check(lake)
    assert spark.table(lake.prefix + USERS.bronze_table).count() == 20
    with pytest.raises(ValueError, match="dedupe"):
        feed.run(lake, dedupe="maybe")


def test_batch_without_events_stops_after_bronze(feed, lake, log):
    feed.add([log.record(None, 1, 0), log.record(None, 2, 0)])
    feed.run(lake)
    assert lake.bronze().count() == 0
    assert lake.version(SILVER) == -1
    feed.add(many(log, 10))
    feed.run(lake)
    assert lake.version(SILVER) == 1
    assert lake.bronze().count() == 10


def test_bronze_only_queries_run_side_by_side(feed, lake, log, spark, tmp_path):
    feed.add(many(log, 10))
    stream = stream_change_log(spark, USERS, path=feed.path)
    queries = jobs.stream_bronze([(stream, lake)], feed.checkpoint, trigger_seconds=None)
    jobs.await_all(queries)
    assert lake.bronze().count() == 10
    assert lake.version(SILVER) == -1
    assert (tmp_path / "checkpoint" / USERS.topic.replace(".", "_")).is_dir()


def test_running_query_stops_on_request(feed, lake, log, spark):
    feed.add(many(log, 10))
    stream = stream_change_log(spark, USERS, path=feed.path)
    query = start_layers(stream, lake, feed.checkpoint, query_name="running", trigger_seconds=1)
    query.processAllAvailable()
    assert query.name == "running"
    assert query.isActive
    jobs.stop([query])
    assert not query.isActive
    feed.check(lake)


def test_progress_is_recorded(feed, lake, log, spark):
    progress = ProgressLog()
    spark.streams.addListener(progress)
    try:
        feed.add(many(log, 10))
        feed.run(lake, query_name="measured")
        for _ in range(50):
            if progress.rows():
                break
            time.sleep(0.1)
        frame = progress.to_frame(spark).where("input_rows > 0")
        assert frame.select("query_name", "input_rows").distinct().collect() == [("measured", 10)]
    finally:
        spark.streams.removeListener(progress)


def test_merge_every_must_be_positive(feed, lake, log, spark):
    with pytest.raises(ValueError, match="merge_every"):
        start_layers(None, lake, "x", merge_every=0)


def test_stream_windows_are_complete_and_count_late_rows(spark, tmp_path):
    minute = 60_000
    batches = [(0, 1, 4, 5), (11, 30), (29, 3)]  # 29 is late but within the watermark, 3 is beyond it
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "source_ts_ms bigint, op_type string"
    for times in batches:
        rows = spark.createDataFrame([(t * minute, "INSERT") for t in times], schema)
        rows.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        start_window_counts(stream, out, str(tmp_path / "cp"), trigger_seconds=None).awaitTermination()
    counted = {r.window_start.minute: r.event_count for r in window_counts(spark, out).collect()}
    assert counted == {0: 3, 5: 1, 10: 1, 25: 1, 30: 1}


def test_a_due_merge_comes_even_if_its_batch_is_empty(feed, lake, log):
    process_batch(log.frame([log.record("c", 1, 1)]), "q-0", lake, merge=False)
    assert lake.version("silver") == -1
    process_batch(log.frame([log.record(None, 1, 2)]), "q-1", lake, merge=True)
    assert lake.version("silver") == lake.last_batch() == lake.version("gold_daily")
    assert lake.read("silver").count() == 1


def test_a_merge_waits_for_its_share_of_silver(lake, log):
    process_batch(many_frame(log, 400), "q-0", lake, merge_share=0.5)
    first = lake.version(SILVER)
    assert first == 0
    process_batch(log.frame([log.record("u", 1, DAY * 20_000, name="Z")]), "q-1", lake, merge_share=0.9)
    assert lake.version(SILVER) == first and 0 < lake.waiting_share() < 0.9
    fresh = fresh_state(lake)
    assert fresh.where("name = 'Z'").count() == 1
    process_batch(log.frame([log.record("u", 2, DAY * 20_000)]), "q-2", lake, merge_share=0.0)
    assert lake.version(SILVER) == lake.last_batch() and lake.waiting_share() == 0


def test_progress_rows_reach_their_table(feed, lake, log, spark, tmp_path):
    progress = ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(progress)
    try:
        feed.add(many(log, 10))
        feed.run(lake, query_name="written")
        for _ in range(100):
            if (tmp_path / "progress" / "_SUCCESS").exists():
                break
            time.sleep(0.1)
        rows = spark.read.parquet(str(tmp_path / "progress")).where("input_rows > 0")
        assert [r.query_name for r in rows.collect()] == ["written"]
        assert progress.rows() == []
    finally:
        spark.streams.removeListener(progress)


def test_file_stream_needs_the_six_columns(spark, tmp_path):
    stream = stream_change_log(spark, USERS, path=str(tmp_path), file_format="json")
    assert stream.schema == schemas.CHANGE_LOG
    assert stream.isStreaming
    with pytest.raises(ValueError, match="file format"):
        stream_change_log(spark, USERS, path=str(tmp_path), file_format="xml")
