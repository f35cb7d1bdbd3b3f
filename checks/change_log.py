"""A change log derived from the ``events`` table, one record per event.

It is deliberately dirty: tombstones, unreadable JSON, unknown operations, null
and malformed values, and event times floored to six hours so that many events
of one key tie.  :mod:`checks.oracles` states the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import Field, TableSpec

ACCOUNTS = TableSpec(
    name="users",
    topic="cdc.users",
    key=(Field("id", "int"),),
    values=(Field("name", "string", "trim"), Field("email", "string", "lower_trim")),
    domain_of="email",
)

#: A second topic, with the even half of the accounts.
VISITORS = TableSpec(
    name="visitors", topic="cdc.visitors", key=ACCOUNTS.key, values=ACCOUNTS.values, domain_of="email"
)

LOG_PARTITIONS = 3
_SIX_HOURS_MS = 21_600_000


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _spread(df: DataFrame, key: str) -> DataFrame:
    """Deal the rows out evenly: they are narrow here and JSON text later, so this is the cheap place."""
    return df.repartition(key)


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six change-log columns for every row of ``events``."""
    n, user = F.col("event_id"), F.col("user_id")
    time = F.col("ts").cast("timestamp")

    def every(k: int):
        return n % k == 0

    operation = (
        F.when(every(103), "t")
        .when(F.col("event_type") == "signup", "c")
        .when(F.col("event_type") == "view", "r")
        .when(F.col("event_type") == "error", "d")
        .otherwise("u")
    )
    name = F.when(~every(17), F.concat(F.lit(" User "), user, F.lit(" ")))
    email = (
        F.when(every(13), F.lit(None).cast("string"))
        .when(every(11), "no-at-sign")
        .when(every(19), F.concat(F.lit("u"), user, F.lit("@a@b")))
        .when(every(23), "nobody@")
        .otherwise(F.concat(F.lit("U"), user, F.lit("@D"), n % 7, F.lit(".Example.com ")))
    )
    image = F.struct(user.cast("int").alias("id"), F.col("name"), F.col("email"))
    older = F.struct(
        user.cast("int").alias("id"),
        F.concat(F.lit(" Old "), user).alias("name"),
        F.concat(F.lit("old"), user, F.lit("@old.example.com")).alias("email"),
    )
    floored = (F.unix_millis(time) - F.pmod(F.unix_millis(time), F.lit(_SIX_HOURS_MS))).cast("long")
    source = F.struct(
        F.lit("1").alias("version"),
        F.lit("postgresql").alias("connector"),
        F.lit("cdc").alias("name"),
        F.unix_millis(time).alias("ts_ms"),
        F.lit("shop").alias("db"),
        F.lit("public").alias("schema"),
        F.lit("users").alias("table"),
        F.when(~every(5), n).alias("lsn"),
        n.alias("txId"),
    )
    envelope = F.to_json(
        F.struct(
            F.when(F.col("op") == "u", older).when(F.col("op") == "d", image).alias("before"),
            F.when(F.col("op") != "d", image).alias("after"),
            source.alias("source"),
            F.col("op"),
            floored.alias("ts_ms"),
        )
    )
    # to_json never gives null here; saying so keeps Spark from building the text
    # once more just to test it.
    text = F.coalesce(envelope, F.lit(""))
    value = F.when(every(97), F.lit(None)).when(every(101), F.lit("{bad")).otherwise(text)
    events = events_table(spark, sf_dir).select("event_id", "user_id", "event_type", "ts")
    return (
        _spread(events, "event_id")
        .select("*", operation.alias("op"), name.alias("name"), email.alias("email"))
        .select(
            user.cast("string").cast("binary").alias("key"),
            value.cast("binary").alias("value"),
            F.lit(ACCOUNTS.topic).alias("topic"),
            (user % LOG_PARTITIONS).cast("int").alias("partition"),
            n.alias("offset"),
            time.alias("timestamp"),
        )
    )


def visitor_log(log: DataFrame) -> DataFrame:
    """The records of accounts with an even number, as they would stand in the second topic."""
    even = F.col("key").cast("string").cast("bigint") % 2 == 0
    return log.where(even).withColumn("topic", F.lit(VISITORS.topic))
