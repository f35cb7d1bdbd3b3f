import random

import pytest

from tidelog import USERS, schemas
from tidelog.operators import apply_changes, insert_if_absent, latest_state, parse_events, to_silver


def _fold(spark, log, batches, mode):
    """Merge batches of records one after the other, in the given order."""
    state = spark.createDataFrame([], schemas.state(USERS))
    for batch in batches:
        changes = latest_state(parse_events(log.frame(batch), USERS), USERS)
        state = apply_changes(state, changes, USERS, mode)
    rows = to_silver(state, USERS).collect()
    return {r.id: (r.source_ts_ms, r.name) for r in rows}


@pytest.mark.parametrize(
    ("batches", "reference", "ordered"),
    [
        ([[("u", 10)], [("d", 5)]], None, (10, "0")),
        ([[("d", 10)], [("u", 5)]], (5, "1"), None),
        ([[("u", 10)], [("u", 5)]], (10, "0"), (10, "0")),
        ([[("u", 10)], [("u", 10)]], (10, "1"), (10, "1")),
        ([[("c", 1), ("u", 2), ("d", 3)]], None, None),
        ([[("u", 7)], [("u", None)]], (7, "0"), (7, "0")),
        ([[("u", None)]], (None, "0"), (None, "0")),
    ],
)
def test_merge_clauses(spark, log, batches, reference, ordered):
    count = iter(range(100))
    made = [[log.record(op, 1, ts, name=str(next(count))) for op, ts in batch] for batch in batches]
    assert _fold(spark, log, made, "reference").get(1) == reference
    assert _fold(spark, log, made, "ordered").get(1) == ordered


def test_equal_time_is_settled_by_lsn_then_offset(spark, log):
    high = log.record("u", 1, 10, lsn=9, name="high lsn")
    low = log.record("u", 1, 10, lsn=8, name="low lsn")
    none = log.record("u", 1, 10, lsn=None, name="no lsn")
    assert _fold(spark, log, [[high], [low], [none]], "ordered")[1] == (10, "high lsn")
    first = log.record("u", 2, 10, lsn=1, name="first")
    second = log.record("u", 2, 10, lsn=1, name="second")
    assert _fold(spark, log, [[second], [first]], "ordered")[2] == (10, "second")


def _random_records(log, seed, n=120):
    rng = random.Random(seed)
    return [
        log.record(
            rng.choice("ccuuudr"),
            rng.randrange(12),
            rng.choice([None, 0, 1, 2, 3, 4]),
            lsn=rng.choice([None, 1, 2]),
            name=str(i),
        )
        for i in range(n)
    ]


def _python_fold(log_records, batches):
    """The three reference clauses, row by row."""
    import json

    target = {}
    for batch in batches:
        newest = {}
        for record in batch:
            e = json.loads(record[1])
            image = e["after"] or e["before"]
            order = tuple(
                (v is not None, v or 0) for v in (e["ts_ms"], e["source"]["lsn"], record[4])
            )
            if image["id"] not in newest or order > newest[image["id"]][0]:
                newest[image["id"]] = (order, e["op"], e["ts_ms"], image["name"])
        for key, (_, op, ts, name) in newest.items():
            if key in target:
                if op == "d":
                    del target[key]
                elif ts is not None and ts >= (target[key][0] or 0):
                    target[key] = (ts, name)
            elif op != "d":
                target[key] = (ts, name)
    return target


@pytest.mark.parametrize("seed", [1, 2])
def test_any_cut_and_order_of_batches(spark, log, seed):
    records = _random_records(log, seed)
    rng = random.Random(seed)
    shuffled = rng.sample(records, len(records))
    cuts = sorted(rng.sample(range(1, len(records)), 3))
    batches = [shuffled[a:b] for a, b in zip([0, *cuts], [*cuts, None], strict=True)]
    batches.append(batches[1])  # one batch delivered again

    whole = to_silver(latest_state(parse_events(log.frame(records), USERS), USERS), USERS)
    expected = {r.id: (r.source_ts_ms, r.name) for r in whole.collect()}
    assert _fold(spark, log, batches, "ordered") == expected
    assert _fold(spark, log, batches, "reference") == _python_fold(log, batches)


def test_window_and_max_by_agree(spark, log):
    bronze = parse_events(log.frame(_random_records(log, 3, 300)), USERS)
    rows = [
        sorted(map(tuple, latest_state(bronze, USERS, m).drop("silver_built_at",
               "bronze_ingested_at").collect()), key=str)
        for m in ("window", "max_by")
    ]
    assert rows[0] == rows[1]
    with pytest.raises(ValueError, match="method"):
        latest_state(bronze, USERS, "other")


def test_update_to_null_keeps_the_old_value_unless_the_after_image_is_asked_for(spark, log):
    before = {"id": 1, "name": "old", "email": "o@x"}
    bronze = parse_events(log.frame([log.record("u", 1, 1, name=None, before=before)]), USERS)
    assert latest_state(bronze, USERS).first().name == "old"
    assert latest_state(bronze, USERS, image="after").first().name is None
    with pytest.raises(ValueError, match="image"):
        latest_state(bronze, USERS, image="both")


def test_unknown_operation_with_a_key_counts_as_live(spark, log):
    bronze = parse_events(log.frame([log.record("t", 1, 1)]), USERS)
    assert to_silver(latest_state(bronze, USERS), USERS).count() == 1


def test_unknown_mode(spark, log):
    empty = spark.createDataFrame([], schemas.state(USERS))
    with pytest.raises(ValueError, match="mode"):
        apply_changes(empty, empty, USERS, "other")


def test_insert_if_absent(spark):
    target = spark.createDataFrame([(1, "kept")], "id int, name string")
    rows = spark.createDataFrame([(1, "x"), (2, "b"), (2, "a"), (3, None)], "id int, name string")
    added = insert_if_absent(target, rows, ["id"])
    assert sorted(map(tuple, added.collect())) == [(2, "a"), (3, None)]
    only_keys = insert_if_absent(target, rows.select("id"), ["id"])
    assert sorted(r.id for r in only_keys.collect()) == [2, 3]
