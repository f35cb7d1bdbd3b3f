"""Catalog tables: bootstrap, append, replace, and native merge where supported.

These serve a catalog whose tables take row-level commands (``provider`` such as
``iceberg`` or ``delta``).  The Parquet layout of :class:`tidelog.sinks.Lake`
needs none of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import schemas
from tidelog.config import TableSpec
from tidelog.functions.events import DELETE
from tidelog.operators.latest import latest_state

# Table properties per provider (fixed values of the table format).
BRONZE_PROPERTIES = {
    "iceberg": {
        "format-version": "2",
        "write.parquet.compression-codec": "zstd",
        "write.metadata.delete-after-commit.enabled": "true",
        "write.metadata.previous-versions-max": "20",
    },
}
SILVER_PROPERTIES = {
    "iceberg": {
        "format-version": "2",
        "write.merge.mode": "merge-on-read",
        "write.update.mode": "merge-on-read",
        "write.delete.mode": "merge-on-read",
        "write.parquet.compression-codec": "zstd",
    },
}
GOLD_PROPERTIES = {"iceberg": {"format-version": "2"}}


def create_if_absent(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    provider: str = "parquet",
    properties: dict[str, str] | None = None,
    location: str | None = None,
) -> None:
    """Create an empty table; an existing one is left as it is.

    With ``location`` the files there are the table's content, so a session whose catalog
    does not know the table finds its rows again.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    extra = ", ".join(f"'{k}' = '{v}'" for k, v in (properties or {}).items())
    clause = f" TBLPROPERTIES ({extra})" if extra else ""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {provider}{where}{clause}")


def bootstrap(spark: SparkSession, spec: TableSpec, provider: str = "parquet") -> list[str]:
    """Create the layer schemas and tables that do not exist yet."""
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    tables = [
        (spec.bronze_table, schemas.bronze(spec), BRONZE_PROPERTIES),
        (spec.silver_table, schemas.silver(spec), SILVER_PROPERTIES),
        (spec.daily_table, schemas.gold_daily(), GOLD_PROPERTIES),
    ]
    if spec.domain_column:
        tables.append((spec.domain_table, schemas.gold_domain(), GOLD_PROPERTIES))
    for table, schema, properties in tables:
        create_if_absent(spark, table, schema, provider, properties.get(provider))
    return [table for table, _, _ in tables]


def append_rows(rows: DataFrame, table: str) -> None:
    """Append to an existing table.  A failure stays a failure: history is never replaced."""
    rows.write.mode("append").insertInto(table)


def replace_table(rows: DataFrame, table: str) -> None:
    """Replace the content of a table that ``rows`` does not read from."""
    rows.write.mode("overwrite").insertInto(table)


def merge_into(bronze_batch: DataFrame, spec: TableSpec, table: str) -> None:
    """Native ``MERGE`` of one batch into a table that supports row-level commands."""
    changes = latest_state(bronze_batch, spec)
    same_key = F.lit(True)
    for key in spec.key_names:
        same_key = same_key & (F.col(f"{table}.{key}") == F.col(f"source.{key}"))
    columns = schemas.silver(spec).names
    values = {c: F.col(f"source.{c}") for c in columns}
    deleted = F.col("source.op_type") == DELETE
    not_older = F.col("source.source_ts_ms") >= F.coalesce(
        F.col(f"{table}.source_ts_ms"), F.lit(0)
    )
    (
        changes.alias("source")
        .mergeInto(table, same_key)
        .whenMatched(deleted)
        .delete()
        .whenMatched(not_older)
        .update({c: v for c, v in values.items() if c not in spec.key_names})
        .whenNotMatched(~deleted)
        .insert(values)
        .merge()
    )
