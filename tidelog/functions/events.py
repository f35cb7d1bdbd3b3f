"""Expressions over flattened change events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.config import ORDER_COLUMNS

# Operation codes of the change envelope (fixed values).
OPERATIONS = {"c": "INSERT", "u": "UPDATE", "d": "DELETE", "r": "SNAPSHOT"}
UNKNOWN = "UNKNOWN"
DELETE = "DELETE"


def op_name(code: Column) -> Column:
    """Readable operation; anything else, null included, is ``UNKNOWN``."""
    named = F.lit(UNKNOWN)
    for short, long in OPERATIONS.items():
        named = F.when(code == short, long).otherwise(named)
    return named


def effective_key(name: str) -> Column:
    """Key of an event: the after-image's, else (deletes) the before-image's."""
    return F.coalesce(F.col(f"after_{name}"), F.col(f"before_{name}"))


def image_value(name: str, image: str = "coalesce") -> Column:
    """Payload value an event stands for.

    ``coalesce`` falls back to the before-image column by column, so an update
    *to* null keeps the old value.  ``after`` takes the after-image as it is and
    uses the before-image only for events that have no after-image.
    """
    after, before = F.col(f"after_{name}"), F.col(f"before_{name}")
    if image == "coalesce":
        return F.coalesce(after, before)
    if image == "after":
        return F.when(F.col("op_type") == DELETE, before).otherwise(after)
    raise ValueError(f"image must be 'coalesce' or 'after', not {image!r}")


def order_key(prefix: str = "") -> Column:
    """Comparable struct: the greater event of one key is the newer one."""
    return F.struct(*[F.col(f"{prefix}{c}") for c in ORDER_COLUMNS])
