"""Report tables that are carried along, against the reports over everything."""

import random

import pytest

from tidelog import USERS, schemas
from tidelog.operators import latest_state, to_silver
from tidelog.operators.kept import carried_extreme
from tidelog.plans import jobs, reports
from tidelog.plans.layers import advance_keyed, advance_newest_events
from tidelog.sinks.keyed import KeyedTable
from tidelog.sinks.lake import DOMAIN, FIGURES, NEWEST
from tidelog.sources.footers import footer_figures


def batches(log, seed, n=6):
    rng = random.Random(seed)
    for _ in range(n):
        yield [
            log.record(rng.choice("cuudd"), rng.randrange(9), rng.choice([None, *range(12)]), email=f"a@{rng.randrange(4)}.org")
            for _ in range(rng.randrange(1, 14))
        ]


@pytest.mark.parametrize("seed", range(3))
def test_kpis_follow_merges(spark, log, lake, tmp_path, seed):
    table = KeyedTable(spark, str(tmp_path / "by_key"), USERS, parts=4)
    for records in batches(log, seed):
        jobs.ingest(log.frame(records), lake, dedupe="none")
        advance_keyed(lake, table)
        whole = reports.silver_kpis(to_silver(latest_state(lake.bronze(), USERS), USERS), USERS)
        kept = reports.kept_kpis(lake.read(FIGURES), lake.read(DOMAIN))
        assert kept.collect()[0] == whole.drop("silver_last_built").collect()[0]


def test_an_extreme_is_sure_unless_its_row_went():
    assert carried_extreme(10, 12, 10, largest=True) == (12, True)
    assert carried_extreme(10, 9, 10, largest=True) == (10, False)
    assert carried_extreme(10, 9, 8, largest=True) == (10, True)
    assert carried_extreme(10, None, None, largest=True) == (10, True)
    assert carried_extreme(10, 3, 12, largest=False) == (3, True)
    assert carried_extreme(10, 11, 10, largest=False) == (10, False)
    assert carried_extreme(None, None, None, largest=False) == (None, True)


def test_newest_events_need_only_the_stored_ones(spark, log, lake):
    for records in batches(log, 4):
        jobs.ingest(log.frame(records), lake, dedupe="none")
        advance_newest_events(lake, rows=5)
        order = lambda df: [(r.kafka_offset,) for r in df.orderBy("kafka_offset").collect()]
        ranked = sorted(
            lake.bronze().collect(),
            key=lambda r: [(x is not None, x) for x in (r.source_ts_ms, r.source_lsn, r.kafka_offset, r.kafka_partition)],
        )[-5:]
        assert order(lake.read(NEWEST)) == sorted((r.kafka_offset,) for r in ranked)
    assert advance_newest_events(lake, rows=5) is None


def test_footers_answer_without_reading_rows(spark, log, lake):
    for records in batches(log, 5, 3):
        jobs.ingest(log.frame(records), lake, dedupe="none")
    columns = ["source_ts_ms", "kafka_offset"]
    found = footer_figures(spark, lake.bronze_files(), schemas.bronze(USERS), columns)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(source_ts_ms), MAX(source_ts_ms)" in plan
    whole = lake.bronze().selectExpr(
        "count(*)", "min(source_ts_ms)", "max(source_ts_ms)", "min(kafka_offset)", "max(kafka_offset)"
    )
    assert tuple(found.first()) == tuple(whole.first())
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
    assert tuple(footer_figures(spark, [], schemas.bronze(USERS), columns).first()) == (0, None, None, None, None)
    with pytest.raises(ValueError):
        footer_figures(spark, [], schemas.bronze(USERS), ["kafka_key"])
