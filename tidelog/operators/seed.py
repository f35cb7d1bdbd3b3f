"""Seeding a keyed table from another one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions import full_name, synthetic_email


def seed_users(people: DataFrame, id_column: str, first: str, last: str) -> DataFrame:
    """``(id, name, email)`` rows made from an id and two name parts."""
    a, b = F.col(first), F.col(last)
    return people.select(
        F.col(id_column).cast("int").alias("id"),
        full_name(a, b).alias("name"),
        synthetic_email(a, b).alias("email"),
    )


def insert_if_absent(target: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``rows`` to append: keys not in ``target``, each key once.

    Of several new rows with one key the least one (by all columns) is taken, so
    a retried job inserts the same row.  Repeated keys are reduced before the
    shuffle; the join then reuses the same partitioning.
    """
    keys = list(key)
    rest = [c for c in rows.columns if c not in keys]
    if rest:
        one = rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
        one = one.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
    else:
        one = rows.distinct()
    absent = one.join(target.select(*keys), keys, "left_anti")
    return absent.select(*rows.columns)
