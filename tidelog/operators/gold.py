"""Gold aggregates, whole and incremental."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.config import TableSpec
from tidelog.functions import event_date


def domain_counts(silver: DataFrame, spec: TableSpec) -> DataFrame:
    """Live rows per mail domain.  Rows without a domain are left out."""
    domain = F.col(spec.domain_column)
    return (
        silver.where(domain.isNotNull())
        .groupBy(domain.alias("email_domain"))
        .agg(F.count("*").alias("user_count"))
        .withColumn("gold_built_at", F.current_timestamp())
    )


def daily_changes(bronze: DataFrame) -> DataFrame:
    """Events per UTC day and operation over the history given."""
    return (
        bronze.where(F.col("source_ts_ms").isNotNull())
        .groupBy(event_date(F.col("source_ts_ms")).alias("change_date"), "op_type")
        .agg(F.count("*").alias("event_count"))
        .withColumn("gold_built_at", F.current_timestamp())
    )


def add_tallies(*tallies: DataFrame) -> DataFrame:
    """Sum daily tallies of disjoint parts of the history.

    Counts add up, so the table follows the history by tallying new events only
    instead of reading everything again.
    """
    rows = tallies[0]
    for more in tallies[1:]:
        rows = rows.unionByName(more)
    return (
        rows.groupBy("change_date", "op_type")
        .agg(F.sum("event_count").alias("event_count"))
        .withColumn("gold_built_at", F.current_timestamp())
    )


def domain_deltas(staged: DataFrame) -> DataFrame:
    """What a merge changes in the rows per domain: one off for each old image, one on for each new one.

    ``staged`` holds the domains ``_old_domain`` and ``_row_domain`` that the touched keys counted for
    before and after; null where a key did not count.
    """
    images = F.array(
        F.struct(F.col("_old_domain").alias("email_domain"), F.lit(-1).cast("long").alias("user_count")),
        F.struct(F.col("_row_domain").alias("email_domain"), F.lit(1).cast("long").alias("user_count")),
    )
    moved = staged.where(F.col("_touched") & ~F.col("_old_domain").eqNullSafe(F.col("_row_domain")))
    changes = moved.select(F.explode(images).alias("c")).select("c.*").where(F.col("email_domain").isNotNull())
    return changes.groupBy("email_domain").agg(F.sum("user_count").alias("user_count"))


def add_domain_deltas(domains: DataFrame, deltas: DataFrame) -> DataFrame:
    """The domain table after ``deltas``; a domain without rows leaves it."""
    rows = domains.select("email_domain", "user_count").unionByName(deltas)
    counted = rows.groupBy("email_domain").agg(F.sum("user_count").alias("user_count"))
    return counted.where(F.col("user_count") != 0).withColumn("gold_built_at", F.current_timestamp())
