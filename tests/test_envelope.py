import pytest

from tidelog import USERS, Field, TableSpec, schemas
from tidelog.operators import daily_changes, latest_state, parse_events, to_silver

GOOD = '{"after":{"id":1,"name":"a","email":"x@y"},"op":"c","ts_ms":7}'


def _parse(log, *texts):
    records = [log.record("c", 1, 0, raw=t) if t is not None else log.record(None, 1, 0)
               for t in texts]
    return parse_events(log.frame(records), USERS).orderBy("kafka_offset").collect()


def test_schema_is_bronze(log, spark):
    assert parse_events(log.frame([]), USERS).schema.names == schemas.bronze(USERS).names


def test_tombstone_is_dropped(log):
    assert len(_parse(log, None, GOOD)) == 1


@pytest.mark.parametrize(
    "text", ["{bad", "{}", "null", "[]", "", '{"schema":{},"payload":{"op":"c"}}']
)
def test_unreadable_json_is_kept_as_unknown(log, text):
    (row,) = _parse(log, text)
    assert (row.op_type, row.id, row.source_ts_ms, row.op) == ("UNKNOWN", None, None, None)
    assert row.kafka_key == "1"


@pytest.mark.parametrize("bad_id", ['"x"', "3000000000"])
def test_wrong_typed_key_keeps_its_siblings(log, bad_id):
    (row,) = _parse(log, GOOD.replace('"id":1', f'"id":{bad_id}'))
    assert (row.id, row.op_type, row.after_name, row.source_ts_ms) == (None, "INSERT", "a", 7)


def test_extra_fields_are_ignored(log):
    (row,) = _parse(log, GOOD[:-1] + ',"more":{"x":1}}')
    assert (row.id, row.op_type) == (1, "INSERT")


def test_event_time_is_the_envelopes_clock(log):
    (row,) = _parse(log, GOOD[:-1] + ',"source":{"ts_ms":99,"lsn":5,"db":"d"}}')
    assert (row.source_ts_ms, row.source_lsn, row.source_db) == (7, 5, "d")


def test_key_comes_from_before_on_delete(log):
    (row,) = parse_events(log.frame([log.record("d", 4, 1)]), USERS).collect()
    assert (row.id, row.after_id, row.before_id, row.op_type) == (4, None, 4, "DELETE")


def test_unreadable_rows_stop_at_silver_and_at_the_daily_tally(log, spark):
    records = [log.record("c", 1, 0, raw=t) for t in ("{bad", "{}", GOOD)]
    bronze = parse_events(log.frame(records), USERS)
    assert to_silver(latest_state(bronze, USERS), USERS).count() == 1
    assert [r.event_count for r in daily_changes(bronze).collect()] == [1]


def test_limited_columns_equal_the_same_columns_of_the_whole(log):
    records = [log.record(op, k, k * 10, lsn=k) for k, op in enumerate("cudrt")]
    records += [log.record("c", 9, 0, raw="{bad")]
    whole = parse_events(log.frame(records), USERS)
    for columns in (["id"], ["op_type", "source_ts_ms"], ["kafka_offset"],
                    ["source_lsn", "after_name", "before_email", "id"]):
        part = parse_events(log.frame(records), USERS, columns)
        assert part.columns == columns
        assert sorted(map(str, part.collect())) == sorted(map(str, whole.select(columns).collect()))


def test_composite_key_and_no_domain(spark, log):
    spec = TableSpec(
        "pairs", "t.pairs", (Field("a", "int"), Field("b", "string")), (Field("v", "bigint"),)
    )
    texts = [
        '{"after":{"a":1,"b":"x","v":10},"op":"c","ts_ms":1}',
        '{"after":{"a":1,"b":"y","v":20},"op":"c","ts_ms":1}',
        '{"after":{"a":1,"b":"x","v":30},"op":"u","ts_ms":2}',
        '{"after":{"a":1,"v":40},"op":"u","ts_ms":2}',
    ]
    bronze = parse_events(log.frame([log.record("c", 1, 0, raw=t) for t in texts]), spec)
    silver = to_silver(latest_state(bronze, spec), spec)
    assert silver.columns == schemas.silver(spec).names
    assert sorted((r.a, r.b, r.v) for r in silver.collect()) == [(1, "x", 30), (1, "y", 20)]
