"""Silver by key: merges that touch only their partitions, and Gold that follows by differences."""

import random

import pytest

from tidelog import USERS
from tidelog.operators import (
    add_domain_deltas,
    domain_counts,
    latest_state,
    parse_events,
    to_silver,
)
from tidelog.plans import jobs
from tidelog.plans.layers import advance_daily, advance_gold, advance_keyed, advance_silver
from tidelog.sinks import keyed
from tidelog.sinks.keyed import PART, KeyedTable
from tidelog.sinks.lake import DAILY, DOMAIN, SILVER
from tidelog.sinks.maintenance import compact_bronze
from tidelog.streaming import process_batch


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "by_key"), USERS, parts=8)


def rows_of(state):
    return sorted((r.id, r.name, r.email, r.source_ts_ms) for r in to_silver(state, USERS).collect())


def random_events(log, seed, n=80, keys=15):
    rng = random.Random(seed)
    hosts = ["a.org", "b.org", "", "c.org"]
    return [
        log.record(
            rng.choice("ccuuudr"),
            rng.randrange(keys),
            rng.randrange(6),
            name=str(k),
            email=rng.choice([None, "plain", f"x@{rng.choice(hosts)}"]),
        )
        for k in range(n)
    ]


def changes(spark, log, records):
    return latest_state(parse_events(log.frame(records), USERS), USERS)


def domains_of(df):
    return sorted((r.email_domain, r.user_count) for r in df.collect())


def test_one_key_rewrites_one_partition(spark, log, table):
    table.merge(changes(spark, log, [log.record("c", k, 1) for k in range(40)]), 0)
    before = table.files()
    assert sorted(before) == list(range(8))
    table.merge(changes(spark, log, [log.record("u", 7, 2, name="new")]), 1)
    after = table.files()
    touched = {part for part in before if before[part] != after[part]}
    held = {r[PART] for r in table.read().where("id = 7").collect()}
    assert touched == held and len(touched) == 1
    assert [r.name for r in table.read().where("id = 7").collect()] == ["new"]


def test_a_merge_leaves_one_file_a_partition(spark, log, table):
    known = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")  # more than the table has partitions
    try:
        table.merge(changes(spark, log, [log.record("c", k, 1) for k in range(400)]), 0)
        table.merge(changes(spark, log, [log.record("u", k, 2, name="new") for k in range(0, 400, 2)]), 1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", known)
    assert {part: len(names) for part, names in table.files().items()} == {part: 1 for part in range(8)}
    assert table.read().where("name = 'new'").count() == 200 and table.read().count() == 400


def test_only_touched_partitions_are_read(spark, log, table):
    table.merge(changes(spark, log, [log.record("c", k, 1) for k in range(40)]), 0)
    plan = table.read([3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_part" in plan and "_part#" in plan
    assert len(table.read([3]).inputFiles()) == 8  # the listing; the filter prunes at run time
    assert table.read([3]).select(PART).distinct().collect() == [(3,)]


@pytest.mark.parametrize("mode", ["ordered", "reference"])
def test_batches_end_at_what_the_lake_has(spark, log, lake, table, mode):
    for seed in range(4):
        jobs.ingest(log.frame(random_events(log, seed)), lake, dedupe="none")
        advance_silver(lake, mode)
    advance_keyed(lake, table, mode)
    assert rows_of(table.read()) == rows_of(lake.read(SILVER))
    assert table.version() == lake.last_batch() and advance_keyed(lake, table, mode) is None


def test_domains_follow_by_differences_without_silver(spark, log, lake, table):
    for seed in range(5):
        jobs.ingest(log.frame(random_events(log, seed)), lake, dedupe="none")
        advance_keyed(lake, table)
        counted = domain_counts(to_silver(table.read(), USERS), USERS)
        assert domains_of(lake.read(DOMAIN)) == domains_of(counted)
    staged = table.staged(table.version())
    plan = add_domain_deltas(lake.read(DOMAIN), staged.selectExpr("_old_domain email_domain", "1L user_count"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "by_key_8" not in text


def test_a_domain_without_rows_leaves_the_table(spark, log, lake, table):
    jobs.ingest(log.frame([log.record("c", 1, 1, email="a@x.org"), log.record("c", 2, 1, email="a@y.org")]), lake)
    advance_keyed(lake, table)
    jobs.ingest(log.frame([log.record("d", 1, 2, email="a@x.org"), log.record("u", 2, 2, email="b@z.org")]), lake)
    advance_keyed(lake, table)
    assert domains_of(lake.read(DOMAIN)) == [("z.org", 1)]


@pytest.mark.parametrize("broken", ["stage", "domain", "half"])
def test_a_merge_that_broke_off_is_finished(spark, log, lake, table, broken, monkeypatch):
    jobs.ingest(log.frame(random_events(log, 1)), lake, dedupe="none")
    advance_keyed(lake, table)
    jobs.ingest(log.frame(random_events(log, 2)), lake, dedupe="none")

    def fail(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        if broken == "stage":  # staged, nothing else
            patch.setattr(lake, "publish", fail)
        elif broken == "domain":  # counted, not replaced
            patch.setattr(table, "replace", fail)
        else:  # some partitions replaced: one is lost on the way
            real = table.replace

            def half(batch):
                real(batch)
                table.folders.drop("merged", f"{batch:012d}")
                table.folders.drop(table._data, f"{PART}={min(table.files())}")
                fail()

            patch.setattr(table, "replace", half)
        with pytest.raises(OSError):
            advance_keyed(lake, table)
    jobs.ingest(log.frame(random_events(log, 3)), lake, dedupe="none")
    again = KeyedTable(spark, table.folders.root, USERS, parts=99)
    assert again.parts == 8
    advance_keyed(lake, again)
    whole = latest_state(lake.bronze(), USERS)
    assert rows_of(again.read()) == rows_of(whole)
    assert domains_of(lake.read(DOMAIN)) == domains_of(domain_counts(to_silver(whole, USERS), USERS))


def test_repeated_and_empty_batches_change_nothing(spark, log, table):
    first = changes(spark, log, [log.record("c", k, 1) for k in range(9)])
    table.merge(first, 3)
    before = table.files()
    table.merge(changes(spark, log, [log.record("u", 1, 9, name="late")]), 3)
    table.merge(first.limit(0), 4)
    assert table.files() == before and table.version() == 4
    with pytest.raises(ValueError):
        table.stage(first, 5, "sideways")


def test_a_partition_whose_rows_are_all_gone(spark, log, table):
    table.merge(changes(spark, log, [log.record("c", 1, 1)]), 0, "reference")
    table.merge(changes(spark, log, [log.record("d", 1, 2)]), 1, "reference")
    assert table.read().count() == 0 and table.files() == {}


def test_a_domain_table_that_was_left_behind_is_counted_once(spark, log, lake, table):
    lake.write_bronze(parse_events(log.frame(random_events(log, 1)), USERS), lake.reserve("a-0"))
    table.merge(latest_state(lake.bronze(), USERS), 0)
    jobs.ingest(log.frame(random_events(log, 2)), lake, dedupe="none")
    advance_keyed(lake, table)
    assert domains_of(lake.read(DOMAIN)) == domains_of(domain_counts(to_silver(table.read(), USERS), USERS))


def test_layers_with_silver_by_key(spark, log, lake, table):
    for step in range(3):
        process_batch(log.frame(random_events(log, step)), f"q-{step}", lake, table=table)
    assert lake.version(SILVER) == -1 and lake.version(DAILY) == lake.version(DOMAIN) == table.version() == 2
    assert rows_of(table.read()) == rows_of(latest_state(lake.bronze(), USERS))
    assert compact_bronze(lake, table=table) == (0, 2)


def test_the_daily_tally_needs_no_silver(spark, log, lake):
    for step in range(2):
        jobs.ingest(log.frame(random_events(log, step)), lake, dedupe="none")
        advance_daily(lake)
    assert lake.version(SILVER) == -1
    assert sum(r.event_count for r in lake.read(DAILY).collect()) == lake.bronze().count()
    jobs.transform(lake)
    # Gold is there already for this history.
    assert advance_gold(lake) == {}


def test_merges_at_once_leave_the_setting_as_it_was(spark):
    known = spark.conf.get(keyed._JOIN_BY_PART)
    first, second = keyed._joins_by_part(spark), keyed._joins_by_part(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(keyed._JOIN_BY_PART) == "false"
    second.__exit__(None, None, None)
    assert spark.conf.get(keyed._JOIN_BY_PART) == known
