"""Newest event per key, and the cleansed current rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.config import ORDER_COLUMNS, TableSpec
from tidelog.functions import clean, email_domain, event_time, image_value, order_key
from tidelog.functions.events import DELETE

METHODS = ("window", "max_by")


def state_inputs(spec: TableSpec) -> list[str]:
    """Bronze columns that :func:`latest_state` reads."""
    images = [f"{side}_{v}" for side in ("before", "after") for v in spec.value_names]
    return [*spec.key_names, *images, *ORDER_COLUMNS, "op_type", "_ingestion_ts"]


def latest_state(
    bronze: DataFrame, spec: TableSpec, method: str = "window", image: str = "coalesce"
) -> DataFrame:
    """Newest event per key, cleansed, with deletes kept so that it can be merged."""
    return _as_state(newest_per_key(_keyed_rows(bronze, spec, image), spec, method), spec)


def state_rows(bronze: DataFrame, spec: TableSpec, image: str = "coalesce") -> DataFrame:
    """Every event with a key as the state row it would leave; for streams, which rank by state."""
    return _as_state(_keyed_rows(bronze, spec, image), spec)


def _keyed_rows(bronze: DataFrame, spec: TableSpec, image: str) -> DataFrame:
    return bronze.where(_has_key(spec)).select(
        *spec.key_names,
        *[image_value(v, image).alias(v) for v in spec.value_names],
        *ORDER_COLUMNS,
        "op_type",
        "_ingestion_ts",
    )


def newest_per_key(rows: DataFrame, spec: TableSpec, method: str = "window") -> DataFrame:
    """One row per key: the greatest by event time, log sequence, offset.

    Both methods reduce before the shuffle, so one task sends at most one row
    per key and a key that holds a third of all events costs no more than any
    other.  ``window`` relies on the rank filter that Catalyst pushes below the
    exchange; ``max_by`` on partial aggregation.
    """
    keys = spec.key_names
    if method == "window":
        newest_first = [F.col(c).desc_nulls_last() for c in ORDER_COLUMNS]
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
        return rows.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")
    if method == "max_by":
        carried = [c for c in rows.columns if c not in keys]
        best = rows.groupBy(*keys).agg(F.max_by(F.struct(*carried), order_key()).alias("_best"))
        return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in carried])
    raise ValueError(f"method must be one of {METHODS}, not {method!r}")


def to_silver(state: DataFrame, spec: TableSpec) -> DataFrame:
    """Live keys only: a newest event that is a delete removes its key."""
    return state.where(F.col("op_type") != DELETE).select(*schemas.silver(spec).names)


def _as_state(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Cleanse the surviving rows; far fewer than the events they came from."""
    domain = email_domain(F.col(spec.domain_of)) if spec.domain_of else F.lit(None)
    ready = rows.select(
        *spec.key_names,
        *[clean(F.col(f.name), f).alias(f.name) for f in spec.values],
        domain.alias(spec.domain_column or "_none"),
        event_time(F.col("source_ts_ms")).alias("source_ts"),
        F.col("_ingestion_ts").alias("bronze_ingested_at"),
        F.current_timestamp().alias("silver_built_at"),
        *ORDER_COLUMNS,
        "op_type",
    )
    return ready.select(*schemas.state(spec).names)


def _has_key(spec: TableSpec):
    present = F.lit(True)
    for name in spec.key_names:
        present = present & F.col(name).isNotNull()
    return present
