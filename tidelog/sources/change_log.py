"""Change-log scans: a Kafka topic, or files holding the same six columns."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.config import Settings, TableSpec

FILE_FORMATS = ("parquet", "orc", "json")


def kafka_options(settings: Settings) -> dict[str, str]:
    """Kafka source options.  SASL options only when the protocol asks for them.

    ``min_partitions`` splits the offset ranges of a topic with few partitions
    over more tasks, so that parsing is not limited to one task per partition.
    """
    if not settings.bootstrap_servers:
        raise ValueError("KAFKA_BOOTSTRAP_SERVERS is not set")
    options = {
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "kafka.security.protocol": settings.security_protocol,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    if settings.min_partitions:
        options["minPartitions"] = str(settings.min_partitions)
    if settings.security_protocol.startswith("SASL"):
        if not settings.kafka_username or not settings.kafka_password:
            raise ValueError("SASL needs KAFKA_USERNAME and KAFKA_PASSWORD")
        login = "org.apache.kafka.common.security.scram.ScramLoginModule required"
        options["kafka.sasl.mechanism"] = settings.sasl_mechanism
        options["kafka.sasl.jaas.config"] = (
            f'{login} username="{_quoted(settings.kafka_username)}"'
            f' password="{_quoted(settings.kafka_password)}";'
        )
    return options


def starting_offsets(marks: DataFrame, topic: str) -> str | None:
    """``startingOffsets`` just behind the highest stored offset of each log partition; None without any.

    ``marks`` has one row per log partition.  Kafka wants every partition named: after
    adding partitions to a topic, scan once from the earliest offset.
    """
    rows = marks.where(F.col("kafka_topic") == topic).collect()
    if not rows:
        return None
    return json.dumps({topic: {str(r.kafka_partition): r.kafka_offset + 1 for r in sorted(rows)}})


def read_change_log(
    spark: SparkSession,
    spec: TableSpec,
    *,
    path: str | None = None,
    file_format: str = "parquet",
    settings: Settings | None = None,
    starting: str | None = None,
    topics: Sequence[str] | None = None,
) -> DataFrame:
    """The change log to its end as a batch DataFrame, from ``starting`` (Kafka only) or the earliest record.

    Of the spec's topic, or of ``topics`` in one scan; files hold whatever they hold.
    """
    if path is not None:
        return _files(spark.read, file_format).load(path)
    options = kafka_options(settings or Settings.from_env())
    if starting:
        options["startingOffsets"] = starting
    return spark.read.format("kafka").options(**options).option("subscribe", _subscribed(spec, topics)).load()


def stream_change_log(
    spark: SparkSession,
    spec: TableSpec,
    *,
    path: str | None = None,
    file_format: str = "parquet",
    settings: Settings | None = None,
    limits: Mapping[str, str] | None = None,
    topics: Sequence[str] | None = None,
) -> DataFrame:
    """Change log as a stream, of the spec's topic or of all ``topics``.

    Intake per trigger is limited by ``maxOffsetsPerTrigger`` on Kafka, and on
    files by ``limits`` (``maxFilesPerTrigger`` or ``maxBytesPerTrigger``).
    """
    if path is not None:
        return _files(spark.readStream, file_format).options(**dict(limits or {})).load(path)
    settings = settings or Settings.from_env()
    intake = {"maxOffsetsPerTrigger": str(settings.max_offsets_per_trigger), **dict(limits or {})}
    reader = spark.readStream.format("kafka").options(**kafka_options(settings))
    return reader.option("subscribe", _subscribed(spec, topics)).options(**intake).load()


def read_jdbc(
    spark: SparkSession, query: str, settings: Settings, *, schema: str | None = None
) -> DataFrame:
    """Remote relational scan; ``query`` runs at the database, ``schema`` types the columns."""
    if not settings.jdbc_url:
        raise ValueError("TIDELOG_JDBC_URL is not set")
    reader = spark.read.format("jdbc").option("url", settings.jdbc_url).option("query", query)
    if settings.jdbc_user:
        reader = reader.option("user", settings.jdbc_user)
    if settings.jdbc_password:
        reader = reader.option("password", settings.jdbc_password)
    if schema:
        reader = reader.option("customSchema", schema)
    return reader.load()


def jdbc_partitions(
    query: str, column: str, lowest: int | None, highest: int | None, partitions: int
) -> dict[str, str]:
    """Options that split ``query`` into ranges of ``column``, one connection and task each.

    Spark puts values outside the bounds and nulls into the outer ranges, so no row is lost if
    the table grows meanwhile.  An empty table, or one with a single value, is read in one piece.
    """
    if partitions < 1:
        raise ValueError("at least one partition is needed")
    options = {"dbtable": f"({query}) AS part_of"}
    if lowest is None or highest is None or partitions == 1 or lowest == highest:
        return options
    return options | {
        "partitionColumn": column,
        "lowerBound": str(lowest),
        "upperBound": str(highest),
        "numPartitions": str(min(partitions, highest - lowest + 1)),
    }


def read_jdbc_ranges(
    spark: SparkSession,
    query: str,
    column: str,
    settings: Settings,
    *,
    partitions: int = 32,
    schema: str | None = None,
) -> DataFrame:
    """As :func:`read_jdbc`, in parallel over ranges of the whole-number ``column``.

    Its bounds come from a query that the database answers, one row.
    """
    bounds = read_jdbc(
        spark, f"SELECT MIN({column}) AS lowest, MAX({column}) AS highest FROM ({query}) AS bounds_of", settings
    ).first()
    options = jdbc_partitions(query, column, bounds[0], bounds[1], partitions)
    reader = spark.read.format("jdbc").option("url", settings.jdbc_url).options(**options)
    if settings.jdbc_user:
        reader = reader.option("user", settings.jdbc_user)
    if settings.jdbc_password:
        reader = reader.option("password", settings.jdbc_password)
    if schema:
        reader = reader.option("customSchema", schema)
    return reader.load()


def _subscribed(spec: TableSpec, topics: Sequence[str] | None) -> str:
    return ",".join(topics) if topics else spec.topic


def _files(reader, file_format: str):
    if file_format not in FILE_FORMATS:
        raise ValueError(f"file format must be one of {FILE_FORMATS}, not {file_format!r}")
    return reader.format(file_format).schema(schemas.CHANGE_LOG)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace('"', '\\"')
