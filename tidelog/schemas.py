"""Schemas of the change log, the event envelope and the layer tables."""

from __future__ import annotations

from pyspark.sql import types as T

from tidelog.config import ORDER_COLUMNS, TableSpec

_SIMPLE = {
    t.simpleString(): t
    for t in (
        T.StringType(),
        T.IntegerType(),
        T.LongType(),
        T.DoubleType(),
        T.BooleanType(),
        T.BinaryType(),
        T.DateType(),
        T.TimestampType(),
    )
}


def _type(ddl: str) -> T.DataType:
    # Parsing other type names needs a running session.
    return _SIMPLE[ddl] if ddl in _SIMPLE else T.DataType.fromDDL(ddl)


def _struct(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _type(ddl)) for name, ddl in columns.items()])


# The six columns a Kafka source delivers; file sources carry the same ones.
CHANGE_LOG = _struct(
    key="binary",
    value="binary",
    topic="string",
    partition="int",
    offset="bigint",
    timestamp="timestamp",
)

# The capture connector's source block (fixed format).
SOURCE_BLOCK = _struct(
    version="string",
    connector="string",
    name="string",
    ts_ms="bigint",
    db="string",
    schema="string",
    table="string",
    lsn="bigint",
    txId="bigint",
)


def row_image(spec: TableSpec) -> T.StructType:
    return T.StructType([T.StructField(f.name, _type(f.type)) for f in spec.fields])


def envelope(spec: TableSpec) -> T.StructType:
    """Change-event envelope; always explicit, never inferred."""
    image = row_image(spec)
    return T.StructType(
        [
            T.StructField("before", image),
            T.StructField("after", image),
            T.StructField("source", SOURCE_BLOCK),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
        ]
    )


def bronze(spec: TableSpec) -> T.StructType:
    """Append-only event history, one flat row per event."""
    schema = _struct(
        kafka_key="string",
        kafka_topic="string",
        kafka_partition="int",
        kafka_offset="bigint",
        kafka_timestamp="timestamp",
        op="string",
        source_ts_ms="bigint",
        source_db="string",
        source_schema="string",
        source_table="string",
        source_lsn="bigint",
    )
    for side in ("before", "after"):
        for f in spec.fields:
            schema = schema.add(f"{side}_{f.name}", _type(f.type))
    for f in spec.key:
        schema = schema.add(f.name, _type(f.type))
    return (
        schema.add("op_type", T.StringType())
        .add("_ingestion_ts", T.TimestampType())
        .add("_source", T.StringType())
    )


def silver(spec: TableSpec) -> T.StructType:
    """Current, cleansed row per live key."""
    schema = row_image(spec)
    if spec.domain_column:
        schema = schema.add(spec.domain_column, T.StringType())
    return (
        schema.add("source_ts_ms", T.LongType())
        .add("source_ts", T.TimestampType())
        .add("bronze_ingested_at", T.TimestampType())
        .add("silver_built_at", T.TimestampType())
    )


def state(spec: TableSpec) -> T.StructType:
    """Newest event per key, deletes included: Silver's columns plus the merge's."""
    source = bronze(spec)
    schema = silver(spec)
    for name in (*ORDER_COLUMNS, "op_type"):
        if name not in schema.names:
            schema = schema.add(name, source[name].dataType)
    return schema


def gold_domain() -> T.StructType:
    return _struct(email_domain="string", user_count="bigint", gold_built_at="timestamp")


def gold_daily() -> T.StructType:
    return _struct(
        change_date="date", op_type="string", event_count="bigint", gold_built_at="timestamp"
    )


def log_marks() -> T.StructType:
    """Highest stored offset per log partition."""
    return _struct(kafka_topic="string", kafka_partition="int", kafka_offset="bigint")


def log_runs() -> T.StructType:
    """Runs of stored offsets per log partition, cut at the bounds of offset blocks."""
    return _struct(
        kafka_topic="string", kafka_partition="int", block="bigint", first_offset="bigint", last_offset="bigint"
    )


def silver_figures() -> T.StructType:
    """Live rows of Silver and their extremes of event time; one row."""
    return _struct(total_users="bigint", earliest_ms="bigint", latest_ms="bigint", figures_built_at="timestamp")
