"""Runs of stored offsets and what they leave out."""

import random

import pytest
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.operators import drop_stored, join_runs, offset_runs
from tidelog.operators.runs import BLOCK
from tidelog.plans import jobs
from tidelog.plans.layers import fresh_records
from tidelog.sinks.lake import RUNS

POSITION = "kafka_topic string, kafka_partition int, kafka_offset bigint"


def runs_by_hand(positions):
    out, last = [], None
    for topic, partition, offset in sorted(set(positions)):
        place = (topic, partition, offset // BLOCK)
        if last and last[0] == place and offset == last[2] + 1:
            last[2] = offset
        else:
            last = [place, offset, offset]
            out.append(last)
    return sorted((*place, first, end) for place, first, end in out)


def positions(seed, n=400, top=3 * BLOCK):
    rng = random.Random(seed)
    near = [(t, p, o) for t in ("a", "b") for p in (0, 1) for o in range(BLOCK - 3, BLOCK + 4)]
    return near + [("a", rng.randrange(2), rng.choice([rng.randrange(60), rng.randrange(top)])) for _ in range(n)]


def test_runs_are_gaps_and_islands(spark):
    rows = positions(1)
    found = offset_runs(spark.createDataFrame(rows + rows[:50], POSITION))
    assert sorted(map(tuple, found.collect())) == runs_by_hand(rows)


def test_joined_runs_equal_the_runs_of_all(spark):
    parts = [positions(k) for k in (1, 2, 3)]
    made = [offset_runs(spark.createDataFrame(p, POSITION)) for p in parts]
    assert sorted(map(tuple, join_runs(*made).collect())) == runs_by_hand(sum(parts, []))


def test_only_positions_outside_all_runs_stay(spark):
    stored, offered = positions(4), positions(5, n=900)
    runs = offset_runs(spark.createDataFrame(stored, POSITION))
    log = spark.createDataFrame([(b"k", b"v", t, p, o, None) for t, p, o in offered + offered[:300]], schemas.CHANGE_LOG)
    found = drop_stored(log, runs)
    assert found.columns == log.columns
    assert sorted((r.topic, r.partition, r.offset) for r in found.collect()) == sorted(set(offered) - set(stored))


def test_exact_ingest_does_not_read_the_history(spark, log, lake):
    first = [log.record("c", k, 1) for k in range(30)]
    assert jobs.ingest(log.frame(first[::2]), lake) == 15
    assert jobs.ingest(log.frame(first + first), lake) == 15
    assert jobs.ingest(log.frame(first), lake) == 0
    files = fresh_records(log.frame(first), lake, "exact").inputFiles()
    assert files and all("/log_runs/" in f for f in files)
    assert lake.read(RUNS).agg(F.sum(F.col("last_offset") - F.col("first_offset") + 1)).first()[0] == 30


def test_an_empty_history_takes_everything(spark, log, lake):
    record = log.record("c", 1, 1)
    assert jobs.ingest(log.frame([record, record]), lake) == 1


@pytest.mark.parametrize("rows", [[], [("a", 0, None)]])
def test_no_positions_make_no_runs(spark, rows):
    assert offset_runs(spark.createDataFrame(rows, POSITION)).count() == 0
