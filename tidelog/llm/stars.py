"""Connected components by alternating large-star and small-star, hubs dealt apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.tables import stored

#: A hub is a node with more than one in so many of all links, so there are at most twice as many hubs.
HUBS = 10_000
#: Rows that a task writes, and tasks at least: rounds on few links are not dealt over all shuffle partitions.
TASK_ROWS, LEAST_TASKS = 100_000, 8


def _sized(df: DataFrame, name: str, rows: int) -> DataFrame:
    """``df``, of about ``rows`` rows, stored by as many tasks as these need (at most its partitions)."""
    return stored(df.coalesce(max(LEAST_TASKS, -(-rows // TASK_ROWS))), name)


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _pointed(links: DataFrame, total: int, node: str, lowest: DataFrame) -> DataFrame:
    """``links`` with ``m``, the smallest neighbour of their ``node``; ``lowest`` has ``node``, ``m`` and ``n``.

    The few hubs are broadcast, so that their links stay where they are; the others have
    at most ``total`` / ``HUBS`` links each and meet by a join.
    """
    often = F.col("n") > max(total // HUBS, 1_000)
    hubs = F.broadcast(lowest.where(often).select(node, F.col("m").alias("hub_m")))
    marked = links.join(hubs, node, "left")
    rest = marked.where("hub_m is null").drop("hub_m").join(lowest.where(~often).select(node, "m"), node)
    return marked.where("hub_m is not null").withColumnRenamed("hub_m", "m").unionByName(rest)


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for every node of ``links(a, b)``.

    Large-star links each node's larger neighbours to its smallest neighbour (or itself), small-star
    its smaller ones and itself.  Rounds grow with the logarithm of the longest chain; each is
    written to the shared folder, as is the result.  Nodes may be of any type that has an order.
    """
    # (v, u) with v > u.
    given = links.where("a is not null and b is not null and a <> b")
    ordered = given.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
    stars = _sized(ordered.distinct(), "links", links.count())
    before = _state(stars)
    while before[0]:
        both = stars.select(F.col("v").alias("x"), F.col("u").alias("y")).union(stars.select("u", "v"))
        lowest = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = _pointed(both.where("y > x"), 2 * before[0], "x", _sized(lowest, "lowest", 2 * before[0]))
        large = large.select(F.col("y").alias("v"), F.col("m").alias("u")).where("v > u").distinct()
        large = _sized(large, "large", before[0])
        lowest = large.groupBy("v").agg(F.min("u").alias("m"), F.count(F.lit(1)).alias("n"))
        small = _pointed(large, before[0], "v", _sized(lowest, "lowest", before[0]))
        small = small.select(F.explode(F.array("u", "v")).alias("v"), F.col("m").alias("u"))
        stars = _sized(small.where("v > u").distinct(), "small", 2 * before[0])
        after = _state(stars)
        if after == before:
            break
        before = after
    top = stars.select(F.col("u").alias("node"), F.col("u").alias("component"))
    found = stars.select(F.col("v").alias("node"), F.col("u").alias("component")).union(top.distinct())
    return _sized(found, "components", 2 * before[0])
