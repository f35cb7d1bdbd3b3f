"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.tables import stored


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for every node of ``links(a, b)``.

    Each round points the neighbours of a node at their smallest one: first the larger
    neighbours, then the smaller.  A round is a partial minimum and a join, so a node
    with very many links is never gathered; rounds grow with the logarithm of the
    longest chain.  Each round is written to the shared folder.
    """
    # (v, u) with v > u: v hangs on u.
    stars = stored(
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
        .distinct(),
        "links",
    )
    before = _state(stars)
    while before[0]:
        both = stars.select(F.col("v").alias("x"), F.col("u").alias("y")).union(stars.select("u", "v"))
        lowest = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.where("y > x").join(lowest, "x").select(F.col("y").alias("v"), F.col("m").alias("u"))
        large = stored(large.where("v > u").distinct(), "large")
        lowest = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(lowest, "v").select(F.explode(F.array("u", "v")).alias("v"), F.col("m").alias("u"))
        stars = stored(small.where("v > u").distinct(), "small")
        after = _state(stars)
        if after == before:
            break
        before = after
    top = stars.select(F.col("u").alias("node"), F.col("u").alias("component"))
    return stars.select(F.col("v").alias("node"), F.col("u").alias("component")).union(top.distinct())
