import pytest
from pyspark.sql import functions as F
from tidelog import USERS, schemas
from tidelog.operators import daily_changes, domain_counts, latest_state, parse_events, to_silver
from tidelog.plans import jobs
from tidelog.plans.layers import (
    advance_gold,
    advance_silver,
    fresh_state,
    rebuild_gold,
    rebuild_silver,
)
from tidelog.sinks import Lake
from tidelog.sinks import lake as lake_module
from tidelog.sinks.lake import DAILY, DOMAIN, SILVER
from tidelog.sinks.maintenance import (
    compact_bronze,
    drop_compacted,
    forget_deletes,
    remove_orphans,
    retire_versions,
)

CLOCKS = ("silver_built_at", "bronze_ingested_at", "gold_built_at", "_ingestion_ts")


def rows(df):
    return sorted(map(tuple, df.drop(*CLOCKS).collect()), key=str)


def batches(log, n=4, size=12):
    ops = "cuurduc"
    made = []
    for b in range(n):
        made.append(
            [
                log.record(
                    ops[(b * size + i) % len(ops)],
                    i % 7,
                    (b * 37 + i * 11) % 50 * 86_400_000,
                    lsn=i,
                    email=f"{i}@d{b}.com",
                )
                for i in range(size)
            ]
        )
    return made


def fill(lake, log, made):
    for batch in made:
        jobs.ingest(log.frame(batch), lake, dedupe="none")


def expected(log, made):
    everything = [r for batch in made for r in batch]
    bronze = parse_events(log.frame(everything), USERS)
    silver = to_silver(latest_state(bronze, USERS), USERS)
    return rows(silver), rows(domain_counts(silver, USERS)), rows(daily_changes(bronze))


def actual(lake):
    return (
        rows(to_silver(lake.read(SILVER), USERS)),
        rows(lake.read(DOMAIN)),
        rows(lake.read(DAILY)),
    )


def test_empty_lake_reads_as_empty_tables(lake):
    assert lake.last_batch() == -1
    assert lake.bronze().schema == schemas.bronze(USERS)
    for table in (SILVER, DOMAIN, DAILY):
        assert lake.read(table).count() == 0
    assert advance_silver(lake) is None
    assert advance_gold(lake) == {}


@pytest.mark.parametrize("every", [1, 2])
def test_incremental_layers_equal_one_pass(lake, log, every):
    made = batches(log)
    for i, batch in enumerate(made):
        fill(lake, log, [batch])
        if (i + 1) % every == 0:
            advance_silver(lake)
            advance_gold(lake)
    assert actual(lake) == expected(log, made)
    rebuild_silver(lake, "max_by")
    rebuild_gold(lake)
    assert actual(lake) == expected(log, made)


def test_reading_fresh_state_needs_no_write(lake, log):
    made = batches(log)
    fill(lake, log, made[:2])
    assert rows(to_silver(fresh_state(lake), USERS)) == expected(log, made[:2])[0]
    advance_silver(lake)
    fill(lake, log, made[2:])
    assert rows(to_silver(fresh_state(lake), USERS)) == expected(log, made)[0]
    assert lake.version(SILVER) == 1


def test_reference_mode_merges_batch_by_batch(lake, log):
    fill(lake, log, [[log.record("u", 1, 10)], [log.record("d", 1, 5)], [log.record("c", 2, 1)]])
    advance_silver(lake, mode="reference")
    assert [r.id for r in lake.read(SILVER).collect()] == [2]
    assert lake.version(SILVER) == 2


def test_second_ingest_of_the_same_log_adds_nothing(lake, log):
    made = batches(log, 1)
    for dedupe in ("exact", "offsets", "exact"):
        jobs.ingest(log.frame(made[0]), lake, dedupe=dedupe)
    assert lake.bronze().count() == len(made[0])


def test_exact_ingest_fills_gaps_and_drops_copies(lake, log):
    (batch,) = batches(log, 1)
    jobs.ingest(log.frame(batch[::2]), lake)
    assert jobs.ingest(log.frame(batch + batch), lake) == len(batch) - len(batch[::2])
    assert lake.bronze().count() == len(batch)


def test_empty_scan_leaves_the_history(lake, log):
    (batch,) = batches(log, 1)
    jobs.ingest(log.frame(batch), lake)
    assert jobs.ingest(log.frame([]), lake) == 0
    assert lake.bronze().count() == len(batch)


def test_owner_keeps_its_number_until_overtaken(lake, log):
    events = parse_events(log.frame(batches(log, 1)[0]), USERS)
    assert lake.reserve("a") == lake.reserve("a") == 0
    assert lake.reserve("b") == 1
    assert lake.reserve("a") == 0
    assert lake.write_bronze(events, 0) == events.count()
    assert lake.write_bronze(events, 0) is None
    lake.write_bronze(events, lake.reserve("c"))
    # "a" is stored and keeps its number; "b" never was and must go behind "c".
    assert lake.reserve("a") == 0
    assert lake.reserve("b") == 3


def test_only_the_newest_reservation_of_a_query_is_kept(lake, log):
    events = parse_events(log.frame(batches(log, 1)[0]), USERS)
    for owner in ("q-0", "q-1", "ingest-x", "q-2"):
        lake.write_bronze(events, lake.reserve(owner))
    assert lake.forget_owners() == 2
    assert lake.reserve("q-2") == 3
    assert lake.reserve("q-3") == 4


def test_uncommitted_folders_are_invisible_and_can_be_removed(lake, log, spark):
    made = batches(log, 2)
    fill(lake, log, made)
    advance_silver(lake)
    broken = lake.folders.at("bronze", "batch=9")
    parse_events(log.frame(made[0]), USERS).write.parquet(broken)
    lake.folders._fs.delete(lake.folders._path(f"{broken}/_SUCCESS"), False)
    again = Lake(spark, lake.root, USERS, buckets=4)
    assert again.last_batch() == 1
    assert again.bronze().count() == sum(map(len, made))
    assert remove_orphans(again) == ["bronze/batch=9"]


def test_compaction_keeps_content_and_later_batches(lake, log):
    made = batches(log, 5)
    fill(lake, log, made[:3])
    assert compact_bronze(lake) is None  # nothing is covered by Silver and Gold yet
    advance_silver(lake)
    advance_gold(lake)
    before = rows(lake.bronze())
    assert compact_bronze(lake, target_bytes=1 << 30) == (0, 2)
    assert rows(lake.bronze()) == before
    assert compact_bronze(lake) is None
    assert drop_compacted(lake) == [0, 1, 2]
    assert rows(lake.bronze()) == before

    fill(lake, log, made[3:])
    assert lake.batches(after=2) == [3, 4]
    advance_silver(lake)
    advance_gold(lake)
    assert actual(lake) == expected(log, made)
    assert compact_bronze(lake) == (3, 4)
    assert lake.bronze().count() == sum(map(len, made))


def test_compaction_deals_rows_out_by_their_size_in_memory(spark, lake, log):
    # The same text again and again: next to nothing on disk, 2 MB in memory.
    made = [[log.record("c", k, k, name="x" * 10_000) for k in range(start, start + 100)] for start in (0, 100)]
    fill(lake, log, made)
    advance_silver(lake)
    advance_gold(lake)
    before = rows(lake.bronze())
    assert compact_bronze(lake, target_bytes=1 << 30, task_bytes=500_000) == (0, 1)
    assert rows(lake.bronze()) == before
    files = lake.bronze().groupBy(F.input_file_name()).agg(F.count("*"), F.min("kafka_offset"), F.max("kafka_offset")).collect()
    assert len(files) >= 4 and max(n for _, n, _, _ in files) < 100
    spans = sorted((low, high) for _, _, low, high in files)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_number_reserved_but_never_written_is_not_lost_in_compaction(lake, log):
    made = batches(log, 4)
    fill(lake, log, made[:1])
    assert lake.reserve("q-7") == 1  # and then the job dies
    fill(lake, log, made[1:3])
    advance_silver(lake)
    advance_gold(lake)
    assert compact_bronze(lake) == (0, 3)
    drop_compacted(lake)
    number = lake.reserve("q-7")
    assert number == 4
    events = parse_events(log.frame(made[3]), USERS)
    assert lake.write_bronze(events, number) == len(made[3])
    advance_silver(lake)
    advance_gold(lake)
    assert actual(lake) == expected(log, made)


def test_old_versions_are_retired(lake, log):
    for batch in batches(log, 3):
        fill(lake, log, [batch])
        advance_silver(lake)
        advance_gold(lake)
    dropped = retire_versions(lake, keep=1)
    assert dropped[SILVER] == [0, 1]
    assert lake.version(SILVER) == 2
    assert lake.read(SILVER).count() > 0
    with pytest.raises(ValueError, match="at least one"):
        lake.retire(SILVER, 0)


def test_forgetting_deletes(lake, log):
    fill(lake, log, [[log.record("d", 1, 5), log.record("d", 2, 50), log.record("c", 3, 1)]])
    advance_silver(lake)
    assert forget_deletes(lake, before_ms=10) == 2
    assert sorted(r.id for r in lake.read(SILVER).collect()) == [2, 3]


def test_bucket_count_may_change(lake, log, spark):
    made = batches(log, 3)
    fill(lake, log, made[:2])
    advance_silver(lake)
    wider = Lake(spark, lake.root, USERS, buckets=6)
    fill(wider, log, made[2:])
    advance_silver(wider)
    assert rows(to_silver(wider.read(SILVER), USERS)) == expected(log, made)[0]
    assert Lake(spark, lake.root, USERS).buckets == 6


def test_merge_shuffles_only_the_changes(lake, log):
    made = batches(log, 2)
    fill(lake, log, made[:1])
    advance_silver(lake)
    fill(lake, log, made[1:])
    plan = fresh_state(lake)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    advance_silver(lake)
    name = lake._folder(SILVER, 1)
    files = lake.spark.read.parquet(lake.folders.at(SILVER, name)).inputFiles()
    assert 0 < len(files) <= 4


def test_sql_names(lake, log, spark):
    made = batches(log, 3)
    fill(lake, log, made)
    advance_silver(lake)
    advance_gold(lake)
    names = lake.register()
    assert names == [lake.prefix + t for t in USERS.layer_tables]
    counted = {n: spark.sql(f"SELECT count(*) AS n FROM {n}").first().n for n in names}
    silver, domains, daily = actual(lake)
    assert list(counted.values()) == [36, len(silver), len(domains), len(daily)]
    assert spark.table(names[1]).columns == schemas.silver(USERS).names
    # Registering again follows the lake.
    fill(lake, log, batches(log, 1))
    lake.register()
    assert spark.table(names[0]).count() == 48
    assert spark.table(names[0]).columns == schemas.bronze(USERS).names
    # A crashed write stays out of sight, and compaction does not change the content.
    parse_events(log.frame(made[0]), USERS).write.parquet(lake.folders.at("bronze", "batch=7"))
    lake.folders._fs.delete(lake.folders._path(lake.folders.at("bronze/batch=7/_SUCCESS")), False)
    assert compact_bronze(lake) == (0, 2)
    lake.register()
    assert spark.table(names[0]).count() == 48


@pytest.mark.parametrize("root", ["bronze/users", "silver", "gold/bronze", "a,b)c", "plain"])
def test_a_root_may_have_any_name(spark, log, tmp_path, root):
    lake = Lake(spark, str(tmp_path / root), USERS, buckets=2)
    for k in range(2):
        jobs.ingest(log.frame([log.record("c", k, k)]), lake)
        jobs.transform(lake)
    assert lake.batches() == [0, 1]
    assert lake.read(SILVER).count() == 2
    assert Lake(spark, str(tmp_path / root), USERS).last_batch() == 1


def test_overlapping_writers_lose_nothing(spark, log, tmp_path):
    first, second = (Lake(spark, str(tmp_path / "lake"), USERS, buckets=2) for _ in range(2))
    number = first.reserve("first-0")
    jobs.ingest(log.frame([log.record("c", 1, 1)]), second)
    jobs.transform(second)
    assert second.version(SILVER) > number
    events = parse_events(log.frame([log.record("c", 2, 2)]), USERS)
    assert first.write_bronze(events, number) == 1
    # The retry of the overtaken batch finds it under its new number.
    assert first.write_bronze(events, first.reserve("first-0")) is None
    jobs.transform(first)
    assert sorted(r.id for r in second.read(SILVER).collect()) == [1, 2]
    assert second.read("gold_daily").agg({"event_count": "sum"}).first()[0] == 2


def test_a_batch_overtaken_while_it_is_written_moves_on(spark, log, tmp_path, monkeypatch):
    first, second = (Lake(spark, str(tmp_path / "lake"), USERS, buckets=2) for _ in range(2))
    number = first.reserve("first-0")
    events = parse_events(log.frame([log.record("c", 2, 2)]), USERS)
    write = lake_module._counted

    def slow(rows, save):
        monkeypatch.setattr(lake_module, "_counted", write)
        jobs.ingest(log.frame([log.record("c", 1, 1)]), second)
        jobs.transform(second)
        return write(rows, save)

    monkeypatch.setattr(lake_module, "_counted", slow)
    first.write_bronze(events, number)
    jobs.transform(first)
    assert sorted(r.id for r in first.read(SILVER).collect()) == [1, 2]


def test_two_writers_that_list_at_once_get_two_numbers(spark, log, tmp_path, monkeypatch):
    first, second = (Lake(spark, str(tmp_path / "lake"), USERS, buckets=2) for _ in range(2))
    one = first.reserve("first-0")
    with monkeypatch.context() as patch:
        # The second writer's listing is from before the first one's reservation.
        patch.setattr(second.folders, "names", lambda *_: [])
        two = second.reserve("second-0")
    assert (one, two) == (0, 1)
    for lake, number, key in ((second, two, 2), (first, one, 1)):
        assert lake.write_bronze(parse_events(log.frame([log.record("c", key, key)]), USERS), number) == 1
    jobs.transform(first)
    assert sorted(r.id for r in second.read(SILVER).collect()) == [1, 2]


def test_a_merge_between_write_and_publication_counts_the_batch_once(spark, log, tmp_path, monkeypatch):
    first, second = (Lake(spark, str(tmp_path / "lake"), USERS, buckets=2) for _ in range(2))
    alone = first._alone

    def overtaken():
        # Written but not published: the other writer commits and merges, twice.
        for key in (1, 3):
            jobs.ingest(log.frame([log.record("c", key, key)]), second)
            jobs.transform(second)
        return alone()

    monkeypatch.setattr(first, "_alone", overtaken)
    events = parse_events(log.frame([log.record("c", 2, 2)]), USERS)
    number = first.reserve("first-0")
    assert first.write_bronze(events, number) == 1
    assert first.write_bronze(events, first.reserve("first-0")) is None
    jobs.transform(first)
    jobs.transform(second)
    assert sorted(r.id for r in second.read(SILVER).collect()) == [1, 2, 3]
    assert second.read("gold_daily").agg({"event_count": "sum"}).first()[0] == 3


def test_the_lock_of_a_dead_writer_is_taken_over(spark, log, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"), USERS, buckets=2)
    events = parse_events(log.frame([log.record("c", 2, 2)]), USERS)
    lake.folders.claim("bronze_lock")
    monkeypatch.setattr(lake_module, "_LOCK_SECONDS", 0.3)
    assert lake.write_bronze(events, lake.reserve("a-0")) == 1
    lake.folders.claim("bronze_lock")
    monkeypatch.setattr(lake.folders, "age_seconds", lambda *_: 0.0)
    with pytest.raises(TimeoutError):
        lake.write_bronze(events, lake.reserve("a-1"))
    assert lake.last_batch() == 0 and lake.drop_unfinished() != []
