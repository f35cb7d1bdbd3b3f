"""Text expressions: cleansing, mail domains and the seed table's synthesis."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.config import Field


def clean(value: Column, field: Field) -> Column:
    """Cleanse one payload column by its rule.  Trimming removes spaces only."""
    if field.clean == "trim":
        return F.trim(value)
    if field.clean == "lower_trim":
        return F.lower(F.trim(value))
    return value


def email_domain(email: Column) -> Column:
    """Lower-cased text between the first and second ``@``; null without an ``@``.

    ``foo@`` yields an empty string, which downstream counts as its own group.
    """
    return F.when(
        email.contains("@"),
        F.lower(F.split_part(F.trim(email), F.lit("@"), F.lit(2))),
    )


def full_name(first: Column, last: Column) -> Column:
    """``first last``; null when either part is null."""
    return F.concat(F.trim(first), F.lit(" "), F.trim(last))


def synthetic_email(first: Column, last: Column, host: str = "example.com") -> Column:
    return F.lower(F.concat(F.trim(first), F.lit("."), F.trim(last), F.lit(f"@{host}")))
