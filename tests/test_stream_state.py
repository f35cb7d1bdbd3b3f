"""Stream state: newest rows with expiry, replayed records, observed counts, many topics."""

import threading
import time

import pytest

from tidelog import Field, TableSpec, USERS, schemas
from tidelog.operators import parse_events, to_silver
from tidelog.plans import topics
from tidelog.plans.jobs import JobFailed
from tidelog.sinks.keyed import KeyedTable
from tidelog.sinks.lake import DAILY, DOMAIN, SILVER, Lake
from tidelog.sources.change_log import jdbc_partitions
from tidelog.streaming import ProgressLog, observed_counts, start_layers
from tidelog.streaming.latest import start_newest

OTHERS = TableSpec(name="others", topic="pgb.public.others", key=(Field("id", "int"),), values=USERS.values, domain_of="email")


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "silver"), USERS, parts=4)


class Feed:
    """A folder of change-log files; each call of ``send`` adds one."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, str(folder)

    def send(self, log, records):
        log.frame(records).coalesce(1).write.mode("append").parquet(self.folder)
        time.sleep(0.05)  # files are read in the order of their time

    def stream(self):
        return self.spark.readStream.schema(schemas.CHANGE_LOG).option("maxFilesPerTrigger", 1).parquet(self.folder)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "log")


def newest(feed, table, tmp_path, **options):
    start_newest(feed.stream(), table, str(tmp_path / "checkpoint"), trigger_seconds=None, **options).awaitTermination()
    return {r.id: r.name for r in to_silver(table.read(), USERS).collect()}


@pytest.mark.parametrize("forget", [None, 3_600_000])
def test_newest_rows_follow_order_not_arrival(feed, log, table, tmp_path, forget):
    feed.send(log, [log.record("c", 1, 10, name="a"), log.record("c", 2, 10, name="b"), log.record("u", 1, 30, name="c")])
    feed.send(log, [log.record("u", 1, 20, name="late"), log.record("d", 2, 40)])
    assert newest(feed, table, tmp_path, forget_deletes_ms=forget) == {1: "c"}
    # The state outlives the query: an older event of a deleted key stays out.
    feed.send(log, [log.record("c", 2, 35, name="older"), log.record("c", 3, None, name="no time"), log.record("u", 1, 30, lsn=1, name="lsn")])
    assert newest(feed, table, tmp_path, forget_deletes_ms=forget) == {1: "lsn", 3: "no time"}


def test_expiry_brings_its_own_state_store(spark, feed, log, table, tmp_path):
    provider = "spark.sql.streaming.stateStore.providerClass"
    plain = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    known = spark.conf.get(provider)
    spark.conf.set(provider, plain)
    try:
        feed.send(log, [log.record("c", 1, 10, name="a"), log.record("c", 2, 10, name="b"), log.record("d", 2, 40)])
        assert newest(feed, table, tmp_path, forget_deletes_ms=3_600_000) == {1: "a"}
        assert spark.conf.get(provider) == plain
    finally:
        spark.conf.set(provider, known)


def test_a_forgotten_delete_lets_the_key_start_anew(feed, log, table, tmp_path):
    feed.send(log, [log.record("c", 1, 10, name="a"), log.record("c", 2, 10, name="b"), log.record("d", 1, 40)])
    assert newest(feed, table, tmp_path, forget_deletes_ms=1) == {2: "b"}
    time.sleep(0.1)
    feed.send(log, [log.record("u", 2, 50, name="timers run")])
    newest(feed, table, tmp_path, forget_deletes_ms=1)
    feed.send(log, [log.record("c", 1, 20, name="again"), log.record("u", 2, 45, name="live keys stay")])
    seen = []
    table.merge, merge = lambda changes, batch: (seen.extend(changes.collect()), merge(changes, batch)), table.merge
    newest(feed, table, tmp_path, forget_deletes_ms=1)
    # The stream has no delete of key 1 any more; Silver by key still keeps its own.
    assert [(r.id, r.name) for r in seen] == [(1, "again")]


def test_a_key_that_came_back_outlives_the_timer(feed, log, table, tmp_path):
    feed.send(log, [log.record("d", 1, 40)])
    feed.send(log, [log.record("c", 1, 50, name="back")])
    newest(feed, table, tmp_path, forget_deletes_ms=1)
    time.sleep(0.1)
    feed.send(log, [log.record("c", 9, 1)])
    newest(feed, table, tmp_path, forget_deletes_ms=1)
    feed.send(log, [log.record("u", 1, 45, name="older")])
    assert newest(feed, table, tmp_path, forget_deletes_ms=1)[1] == "back"


def test_a_table_belongs_to_its_checkpoint(feed, log, table, tmp_path):
    feed.send(log, [log.record("c", 1, 10)])
    newest(feed, table, tmp_path)
    with pytest.raises(Exception, match="another checkpoint"):
        newest(feed, table, tmp_path / "other")


def test_replayed_records_are_left_out(spark, log, lake, tmp_path):
    from datetime import datetime, timedelta

    start = datetime(2024, 1, 1)
    records = [(*log.record("c", k, k)[:5], start + timedelta(minutes=k)) for k in range(60)]
    folder = str(tmp_path / "log")
    for part in (records[:30], records[30:], records[20:], records[50:] + records[50:]):
        spark.createDataFrame(part, schemas.CHANGE_LOG).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)
    source = spark.readStream.schema(schemas.CHANGE_LOG).option("maxFilesPerTrigger", 1).parquet(folder)
    start_layers(source, lake, str(tmp_path / "c"), trigger_seconds=None, bronze_only=True, replay_within="2 hours").awaitTermination()
    assert sorted(r.kafka_offset for r in lake.bronze().collect()) == [r[4] for r in records]


def test_a_longer_replay_has_more_files_and_the_same_steps(spark, log, tmp_path, monkeypatch):
    from datetime import datetime, timedelta

    from checks import registry

    start = datetime(2024, 1, 1)
    records = [(*log.record("c", k, k)[:5], start + timedelta(minutes=k)) for k in range(61)]
    frame = spark.createDataFrame(records, schemas.CHANGE_LOG)
    for most, step in ((100, 2), (5, 6)):
        monkeypatch.setattr(registry, "_REPLAY_FILE_RECORDS", most)
        folder = tmp_path / f"staged-{most}"
        assert registry._stage_replay(frame, str(folder)) == (step, f"{20 * 60 + 3600} seconds")
        files = sorted(folder.glob("log/part-*"), key=lambda f: f.stat().st_mtime)
        assert len(files) == 4 * step
        minutes = [[(r.timestamp - start).seconds // 60 for r in spark.read.parquet(str(f)).collect()] for f in files]
        steps = [sorted(sum(minutes[k : k + step], [])) for k in range(0, 4 * step, step)]
        assert sum(steps[:3], []) == list(range(61)) and steps[3] == list(range(40, 61))


def test_observed_counts_are_stored_with_the_progress(spark, feed, log, lake, tmp_path):
    feed.send(log, [log.record("c", 1, 1), log.record("u", 1, 2), log.record("x", 0, 0, raw="{bad"), log.record(None, 5, 0)])
    feed.send(log, [log.record("d", 1, 3), log.record("t", 2, 3)])
    listener = ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(listener)
    try:
        options = {"trigger_seconds": None, "bronze_only": True, "metrics": True}
        start_layers(feed.stream(), lake, str(tmp_path / "c"), **options).awaitTermination()
        listener.settle()
    finally:
        spark.streams.removeListener(listener)
    counts = dict(map(tuple, observed_counts(spark.read.parquet(str(tmp_path / "progress"))).collect()))
    assert counts == {
        "events": 5, "op_INSERT": 1, "op_UPDATE": 1, "op_DELETE": 1, "op_SNAPSHOT": 0, "op_UNKNOWN": 2, "unreadable": 1, "null_keys": 1,
    }
    assert lake.bronze().count() == 5
    with pytest.raises(ValueError, match="dedupe"):
        start_layers(feed.stream(), lake, str(tmp_path / "d"), metrics=True, dedupe="exact")


def mixed(log, n, start=0):
    rows = [log.record("c", k, k, email=f"e@{k % 2}.org") for k in range(start, start + n)]
    return [(*r[:2], OTHERS.topic, *r[3:]) if k % 3 == 0 else r for k, r in enumerate(rows)]


@pytest.fixture
def lakes(spark, tmp_path):
    return {spec.topic: Lake(spark, str(tmp_path / spec.name), spec, buckets=2) for spec in (USERS, OTHERS)}


def test_one_stream_feeds_every_topic(spark, feed, log, lakes, tmp_path):
    feed.send(log, mixed(log, 9))
    feed.send(log, mixed(log, 6, 9))
    tables = {OTHERS.topic: KeyedTable(spark, str(tmp_path / "others_by_key"), OTHERS, parts=2)}
    topics.start_topics(
        feed.stream(), lakes, str(tmp_path / "c"), str(tmp_path / "staging"), tables=tables, trigger_seconds=None
    ).awaitTermination()
    users, others = lakes[USERS.topic], lakes[OTHERS.topic]
    assert users.bronze().count() == 10 and others.bronze().count() == 5
    assert {r.kafka_topic for r in others.bronze().collect()} == {OTHERS.topic}
    assert users.version(SILVER) == users.version(DAILY) == 1 and others.version(SILVER) == -1
    assert sum(r.user_count for r in others.read(DOMAIN).collect()) == tables[OTHERS.topic].read().count() == 5


def test_a_failing_topic_does_not_hold_up_the_others(spark, log, lakes, tmp_path, monkeypatch):
    folders = topics.Folders(spark, str(tmp_path / "staging"))
    topics.deal_out(log.frame(mixed(log, 9)), folders, "q-0")
    broken = lakes[OTHERS.topic]
    with monkeypatch.context() as patch:
        patch.setattr(broken, "write_bronze", lambda *_: 1 / 0)
        with pytest.raises(JobFailed, match="others"):
            topics.process_topics(topics.topics_of(spark, folders, "q-0"), "q-0", lakes)
    assert lakes[USERS.topic].bronze().count() == 6
    # The same batch again, as a restarted query repeats it.
    topics.deal_out(log.frame([]), folders, "q-0")
    topics.process_topics(topics.topics_of(spark, folders, "q-0"), "q-0", lakes)
    assert lakes[USERS.topic].bronze().count() == 6 and broken.bronze().count() == 3


def test_topics_run_side_by_side_and_those_of_one_lake_in_order(spark, log, lakes, monkeypatch):
    met, running, order = threading.Barrier(2), set(), []

    def meet(rows, owner, lake, **_):
        assert spark.sparkContext.getLocalProperty("who") == "caller"
        met.wait(60)  # broken unless both are here

    def alone(rows, owner, lake, **_):
        assert not running
        running.add(owner)
        time.sleep(0.3)
        running.remove(owner)
        order.append(lake)

    parts = dict.fromkeys(lakes, log.frame([]))
    spark.sparkContext.setLocalProperty("who", "caller")
    try:
        monkeypatch.setattr(topics, "process_batch", meet)
        topics.process_topics(parts, "q-0", lakes)
    finally:
        spark.sparkContext.setLocalProperty("who", None)
    monkeypatch.setattr(topics, "process_batch", alone)
    topics.process_topics(parts, "q-0", dict.fromkeys(lakes, lakes[USERS.topic]))
    assert len(order) == 2
    monkeypatch.setattr(topics, "process_batch", lambda rows, owner, lake, **_: 1 / 0)
    with pytest.raises(JobFailed) as failed:
        topics.process_topics(parts, "q-0", lakes)
    assert set(failed.value.failures) == set(lakes)


def test_a_batch_is_dealt_out_into_files_of_bounded_size(spark, log, tmp_path, monkeypatch):
    monkeypatch.setattr(topics, "_FILE_RECORDS", 2)
    folders = topics.Folders(spark, str(tmp_path / "staging"))
    topics.deal_out(log.frame(mixed(log, 9)).coalesce(1), folders, "q-0")
    files = [n for n in folders.names("topics", "q-0", f"topic={USERS.topic}") if n.endswith(".parquet")]
    assert len(files) == 3
    assert topics.topics_of(spark, folders, "q-0")[USERS.topic].count() == 6


def test_a_topic_without_a_lake_is_named(spark, log, lakes, tmp_path):
    folders = topics.Folders(spark, str(tmp_path / "staging"))
    strange = [(*r[:2], "7", *r[3:]) for r in mixed(log, 2)]
    topics.deal_out(log.frame(mixed(log, 3) + strange), folders, "q-0")
    with pytest.raises(JobFailed, match="unknown topic '7'"):
        topics.process_topics(topics.topics_of(spark, folders, "q-0"), "q-0", lakes)
    assert lakes[USERS.topic].bronze().count() == 2
    topics.deal_out(log.frame([]), folders, "q-1")
    assert topics.topics_of(spark, folders, "q-1") == {}
    with pytest.raises(ValueError):
        topics.start_topics(None, {}, "c", "s")


def test_jdbc_ranges_cover_the_table():
    parts = jdbc_partitions("SELECT * FROM t", "id", 5, 104, 8)
    assert parts == {
        "dbtable": "(SELECT * FROM t) AS part_of", "partitionColumn": "id", "lowerBound": "5", "upperBound": "104", "numPartitions": "8",
    }
    assert jdbc_partitions("q", "id", 1, 3, 8)["numPartitions"] == "3"
    for low, high, n in ((None, None, 8), (4, 4, 8), (1, 9, 1)):
        assert list(jdbc_partitions("q", "id", low, high, n)) == ["dbtable"]
    with pytest.raises(ValueError):
        jdbc_partitions("q", "id", 1, 2, 0)


def test_observed_stream_has_bronze_rows(spark, feed, log):
    feed.send(log, [log.record("c", 1, 1)])
    assert parse_events(feed.stream(), USERS).isStreaming


def test_the_command_line_takes_several_topics(spark, log, tmp_path, monkeypatch):
    from tidelog import cli, config

    monkeypatch.setitem(config.REGISTRY, OTHERS.topic, OTHERS)

    class Kept:
        def __init__(self, session):
            self.session = session

        def __getattr__(self, name):
            return (lambda: None) if name == "stop" else getattr(self.session, name)

    monkeypatch.setattr(cli, "build_session", lambda app: Kept(spark))
    path = str(tmp_path / "log")
    log.frame(mixed(log, 9)).coalesce(1).write.parquet(path)
    names = ["--topics", f"{USERS.topic}, {OTHERS.topic}", "--source-path", path]
    batch = ["--root", str(tmp_path / "batch")]
    assert cli.main(["--mode", "kafka", *names, *batch]) == 0
    assert cli.main(["--mode", "transform", *names, *batch]) == 0
    users, others = (Lake(spark, str(tmp_path / "batch" / spec.name), spec) for spec in (USERS, OTHERS))
    assert (users.bronze().count(), others.bronze().count()) == (6, 3)
    assert users.read(SILVER).count() == 6
    streamed = ["--root", str(tmp_path / "stream"), "--checkpoint-dir", str(tmp_path / "c"), "--available-now", "--silver-parts", "2"]
    assert cli.main(["--mode", "streaming", *names, *streamed]) == 0
    assert Lake(spark, str(tmp_path / "stream" / "others"), OTHERS).bronze().count() == 3
    with pytest.raises(SystemExit):
        cli.main(["--mode", "reports", *names, *batch])
    with pytest.raises(ValueError, match="unknown topic"):
        cli.main(["--mode", "kafka", "--topics", "nope", *batch])


def test_late_rows_are_told_apart(spark, tmp_path):
    from datetime import datetime, timedelta

    from tidelog.streaming.late import fold_tallies, late_events, start_window_tallies, window_tallies

    start = datetime(2024, 1, 1)
    at = lambda *minutes: [(start + timedelta(minutes=m) if m is not None else None, "UPDATE") for m in minutes]
    folder, out = str(tmp_path / "events"), str(tmp_path / "out")
    schema = "source_ts timestamp, op_type string"
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    run = lambda: start_window_tallies(stream(), out, str(tmp_path / "c"), trigger_seconds=None).awaitTermination()
    # Within a batch nothing is late; the second batch is behind minute 30 - 10.
    for rows in (at(1, 30), at(14, 16, 21, 3, None)):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)
    run()
    minutes = lambda df: sorted(((r.window_start - start).seconds // 60, r.event_count, r.final) for r in df.collect())
    wanted = [(0, 1, True), (20, 1, False), (30, 1, False)]
    assert minutes(window_tallies(spark, out)) == wanted
    late = sorted((r.source_ts is None, r.source_ts, r.batch) for r in late_events(spark, out).collect())
    assert [(n, b) for n, _, b in late] == [(False, 1), (False, 1), (False, 1), (True, 1)]
    assert fold_tallies(spark, out) == 1 and fold_tallies(spark, out) == 1
    assert minutes(window_tallies(spark, out)) == wanted
    spark.createDataFrame(at(22, 19, 50), schema).coalesce(1).write.mode("append").parquet(folder)
    run()
    assert minutes(window_tallies(spark, out)) == [(0, 1, True), (20, 2, True), (30, 1, True), (50, 1, False)]
    assert late_events(spark, out).count() == 5
    assert window_tallies(spark, str(tmp_path / "nothing")).count() == 0
