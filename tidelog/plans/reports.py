"""Operational reports over the layer tables.

Each report is a DataFrame built from the table it names; nothing is collected.
Ordered reports break ties on every remaining column, so the result is the same
on every run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.config import ORDER_COLUMNS, TableSpec
from tidelog.functions import event_time
from tidelog.operators.gold import daily_changes
from tidelog.sources.catalog import discover, has_table

# -- Bronze -------------------------------------------------------------------


def op_mix(bronze: DataFrame) -> DataFrame:
    """Events per operation with first and last event time, most frequent first."""
    return (
        bronze.groupBy("op_type")
        .agg(
            F.count("*").alias("event_count"),
            F.min("source_ts_ms").alias("_first"),
            F.max("source_ts_ms").alias("_last"),
        )
        .select(
            "op_type",
            "event_count",
            event_time(F.col("_first")).alias("first_event"),
            event_time(F.col("_last")).alias("last_event"),
        )
        .orderBy(F.desc("event_count"), "op_type")
    )


def op_counts(bronze: DataFrame) -> DataFrame:
    """Events per operation, most frequent first."""
    counts = bronze.groupBy("op_type").agg(F.count("*").alias("event_count"))
    return counts.orderBy(F.desc("event_count"), "op_type")


def daily_activity(daily: DataFrame) -> DataFrame:
    """The whole daily tally, oldest day first."""
    return daily.select("change_date", "op_type", "event_count").orderBy("change_date", "op_type")


def recent_days(daily: DataFrame, rows: int = 30) -> DataFrame:
    """Newest ``rows`` rows (not days) of the daily tally."""
    newest = daily.orderBy(F.col("change_date").desc_nulls_last(), F.col("op_type").asc())
    return newest.limit(rows).select("change_date", "op_type", "event_count")


def latest_events(bronze: DataFrame, spec: TableSpec, rows: int = 20) -> DataFrame:
    """Newest ``rows`` events."""
    newest = bronze.orderBy(*[F.col(c).desc_nulls_last() for c in ORDER_COLUMNS]).limit(rows)
    return newest.select(
        *spec.key_names,
        "op_type",
        *[f"after_{v}" for v in spec.value_names],
        event_time(F.col("source_ts_ms")).alias("source_ts"),
        "_ingestion_ts",
    )


# -- Silver -------------------------------------------------------------------


def silver_kpis(silver: DataFrame, spec: TableSpec, approximate: bool = False) -> DataFrame:
    """Row count, distinct domains, event-time range and last build time.

    The distinct count is exact unless ``approximate`` is asked for.
    """
    domain = F.col(spec.domain_column) if spec.domain_column else F.lit(None).cast("string")
    distinct = F.approx_count_distinct(domain) if approximate else F.count_distinct(domain)
    return silver.agg(
        F.count("*").alias("total_users"),
        distinct.alias("unique_domains"),
        F.min("source_ts").alias("earliest_record"),
        F.max("source_ts").alias("latest_record"),
        F.max("silver_built_at").alias("silver_last_built"),
    )


def kept_kpis(figures: DataFrame, domains: DataFrame) -> DataFrame:
    """The row count, distinct domains and event-time range of :func:`silver_kpis`, from tables that merges carry along.

    Every domain that live rows have is a row of the domain table, so its rows are the distinct count.
    """
    distinct = domains.agg(F.count("*").alias("n")).scalar()
    return figures.select(
        "total_users",
        distinct.alias("unique_domains"),
        event_time(F.col("earliest_ms")).alias("earliest_record"),
        event_time(F.col("latest_ms")).alias("latest_record"),
    )


def sample_rows(silver: DataFrame, spec: TableSpec, rows: int = 20) -> DataFrame:
    """First ``rows`` live rows by key."""
    domain = [spec.domain_column] if spec.domain_column else []
    return silver.orderBy(*spec.key_names).limit(rows).select(
        *spec.key_names, *spec.value_names, *domain, "source_ts"
    )


def quality_checks(silver: DataFrame, name: str = "name", email: str = "email") -> DataFrame:
    """Counts of null names, null mail addresses and addresses without an ``@``."""

    def rows_where(condition):
        return F.sum(F.when(condition, 1).otherwise(0))

    return silver.agg(
        rows_where(F.col(name).isNull()).alias("null_names"),
        rows_where(F.col(email).isNull()).alias("null_emails"),
        rows_where(~F.col(email).like("%@%")).alias("bad_emails"),
        F.count("*").alias("total_rows"),
    )


# -- Gold ---------------------------------------------------------------------


def domain_share(
    domains: DataFrame, rows: int | None = 20, percent: str = "pct"
) -> DataFrame:
    """Domains by size with their percentage of all rows, not of the rows shown.

    The largest ``rows`` of them, or all.  The total is a scalar subquery over
    partial sums: ``SUM() OVER ()`` would move every domain into one task.
    """
    total = domains.agg(F.sum("user_count").alias("total")).scalar()
    ordered = domains.orderBy(F.desc("user_count"), "email_domain")
    shown = ordered if rows is None else ordered.limit(rows)
    share = F.round(F.col("user_count") * F.lit(100.0) / total, 2)
    return shown.select("email_domain", "user_count", share.cast("double").alias(percent))


def freshness(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Last write time of each layer, as one row."""
    silver_last = silver.agg(F.max("silver_built_at").alias("t")).scalar()
    gold_last = gold.agg(F.max("gold_built_at").alias("t")).scalar()
    last = bronze.agg(F.max("_ingestion_ts").alias("bronze_last_ingest"))
    return last.select(
        "bronze_last_ingest",
        silver_last.alias("silver_last_build"),
        gold_last.alias("gold_last_build"),
    )


# -- All layers ---------------------------------------------------------------


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table, tagged with its name."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("layer"), "rows")
        for name, df in tables.items()
    ]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


# -- Runner -------------------------------------------------------------------


def run(
    spark: SparkSession, spec: TableSpec, section: str | None = None, prefix: str = ""
) -> dict[str, DataFrame]:
    """Reports of one section, or of all; reports on missing tables are left out."""
    if section is not None and section not in SECTIONS:
        raise ValueError(f"section must be one of {sorted(SECTIONS)}, not {section!r}")
    result: dict[str, DataFrame] = {}
    for name in [section] if section else SECTIONS:
        result.update(SECTIONS[name](spark, spec, prefix))
    return result


def show(result: dict[str, DataFrame], rows: int = 25) -> None:
    """Print the first rows of each report; only those rows leave the cluster."""
    for title, df in result.items():
        print(f"\n--- {title} ---")
        first = df.limit(rows + 1).toPandas()
        print(first.head(rows).to_string(index=False) if len(first) else "(no rows)")
        if len(first) > rows:
            print(f"... ({df.count() - rows} more rows)")


def _present(spark, spec, prefix) -> dict[str, DataFrame]:
    return {
        table: spark.table(prefix + table)
        for table in spec.layer_tables
        if has_table(spark, prefix + table)
    }


def _counts(spark, spec, prefix):
    reports = {}
    for layer in ("bronze", "silver", "gold"):
        if spark.catalog.databaseExists(prefix + layer):
            reports[f"tables in {layer}"] = discover(spark, "tables", prefix + layer)
    tables = _present(spark, spec, prefix)
    if tables:
        reports["row counts"] = layer_counts(tables)
    if {spec.bronze_table, spec.silver_table, spec.domain_table} <= set(tables):
        reports["freshness"] = freshness(
            tables[spec.bronze_table], tables[spec.silver_table], tables[spec.domain_table]
        )
    return reports


def _bronze(spark, spec, prefix):
    bronze = _present(spark, spec, prefix).get(spec.bronze_table)
    if bronze is None:
        return {}
    return {
        "operation mix": op_mix(bronze),
        "daily activity (newest 30 rows)": recent_days(daily_changes(bronze)),
        "latest 20 events": latest_events(bronze, spec),
    }


def _silver(spark, spec, prefix):
    silver = _present(spark, spec, prefix).get(spec.silver_table)
    if silver is None:
        return {}
    reports = {
        "silver KPIs": silver_kpis(silver, spec),
        "sample rows (first 20 by key)": sample_rows(silver, spec),
    }
    if {"name", "email"} <= set(spec.value_names):
        reports["data quality"] = quality_checks(silver)
    return reports


def _gold(spark, spec, prefix):
    tables = _present(spark, spec, prefix)
    reports = {}
    if spec.domain_table in tables:
        reports["top 20 domains"] = domain_share(tables[spec.domain_table])
    if spec.daily_table in tables:
        reports["daily change tally"] = recent_days(tables[spec.daily_table])
    return reports


SECTIONS: dict[str, Callable[[SparkSession, TableSpec, str], dict[str, DataFrame]]] = {
    "counts": _counts,
    "bronze": _bronze,
    "silver": _silver,
    "gold": _gold,
}
