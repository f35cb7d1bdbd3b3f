"""Discovery of catalogs, schemas and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException


def discover(
    spark: SparkSession, what: str = "tables", schema: str | None = None, like: str | None = None
) -> DataFrame:
    """``SHOW CATALOGS | SCHEMAS | TABLES``, optionally by name pattern."""
    statement = {"catalogs": "SHOW CATALOGS", "schemas": "SHOW SCHEMAS", "tables": "SHOW TABLES"}
    if what not in statement:
        raise ValueError(f"what must be one of {sorted(statement)}, not {what!r}")
    query = statement[what]
    if schema is not None:
        query += f" IN {_identifier(schema)}"
    if like is not None:
        escaped = like.replace("\\", "\\\\").replace("'", "\\'")
        query += f" LIKE '{escaped}'"
    return spark.sql(query)


def has_table(spark: SparkSession, table: str) -> bool:
    try:
        return spark.catalog.tableExists(table)
    except AnalysisException:
        return False


def _identifier(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))
