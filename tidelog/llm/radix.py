"""Distributed least-significant-digit radix sort: ranks of all rows, without a global sort.

Every row has a place.  A pass is a stable counting sort by one digit: places are cut into
chunks, the rows of each (chunk, digit) are counted, and prefix sums over digits, then over
chunks, give where each one's rows begin.  A row's new place is that offset plus its number
among the rows of its chunk and digit.  Rows move by chunk, so tasks stay the same size
whatever the keys are: a key that a third of all rows share is spread over chunks like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.tables import stored

#: Bits of a digit, and of the places of a chunk.
DIGIT_BITS, CHUNK_BITS = 11, 16


def _pass(rows: DataFrame, digit: Column) -> DataFrame:
    """``rows`` with the places that a stable sort by ``digit`` gives."""
    keyed = rows.withColumn("_digit", digit.cast("int")).withColumn("_chunk", F.shiftright("place", CHUNK_BITS))
    counts = keyed.groupBy("_digit", "_chunk").agg(F.count(F.lit(1)).alias("n"))
    # At most 2 ** DIGIT_BITS totals, so one task may add them up.
    totals = counts.groupBy("_digit").agg(F.sum("n").alias("n"))
    before = Window.orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_digit", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("_digit").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("ahead", F.coalesce(F.sum("n").over(within), F.lit(0))).join(F.broadcast(bases), "_digit")
    # One row per chunk, which meets the chunk's rows without moving them again.
    offsets = offsets.groupBy("_chunk").agg(
        F.map_from_entries(F.collect_list(F.struct("_digit", (F.col("base") + F.col("ahead")).alias("o")))).alias("at")
    )
    dense = F.transform(F.sequence(F.lit(0), F.lit((1 << DIGIT_BITS) - 1)), lambda d: F.coalesce(F.col("at")[d], F.lit(0)))
    offsets = offsets.select("_chunk", dense.alias("_starts"))
    nth = F.row_number().over(Window.partitionBy("_chunk", "_digit").orderBy("place")) - 1
    dealt = keyed.repartition("_chunk").withColumn("_nth", nth)
    moved = dealt.join(offsets.hint("merge"), "_chunk").withColumn("place", F.col("_starts")[F.col("_digit")] + F.col("_nth"))
    return stored(moved.select(rows.columns), "pass")


def ranked(rows: DataFrame, order: list[tuple[str, bool]]) -> DataFrame:
    """``rows`` with ``place``, from 0: their order by ``order``, pairs of a long column and whether it descends.

    The first pair weighs most.  Nulls come last in their column.  Rows equal in all of them
    keep the order in which the rows are read.  There are as many passes as the columns' ranges have digits.
    """
    rows = stored(rows.withColumn("place", F.monotonically_increasing_id()), "rows")
    ends = rows.agg(
        *[f(c).alias(f"{k}{i}") for i, (c, _) in enumerate(order) for k, f in (("low", F.min), ("high", F.max))],
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"null{i}") for i, (c, _) in enumerate(order)],
        F.count(F.lit(1)).alias("n"),
    ).first()
    passes = []
    for i, (column, descends) in reversed(list(enumerate(order))):
        low, high = ends[f"low{i}"], ends[f"high{i}"]
        if low is not None:
            value = F.col(f"`{column}`")
            if high - low < 1 << 63:
                value, differ = (F.lit(high) - value if descends else value - F.lit(low)), (high - low).bit_length()
            else:  # With the sign bit turned, bits order longs as unsigned numbers; all bits turned, downwards.
                value, differ = value.bitwiseXOR(F.lit(-(1 << 63))), 64
                value = F.bitwise_not(value) if descends else value
            for shift in range(0, differ, DIGIT_BITS):
                digit = F.shiftrightunsigned(value, shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))
                passes.append(F.coalesce(digit, F.lit(0)))
        if ends[f"null{i}"] and ends["n"] > ends[f"null{i}"]:
            passes.append(F.col(f"`{column}`").isNull().cast("int"))
    # Without a pass places are still sparse: one digit for all rows makes them dense.
    for digit in passes or [F.lit(0)]:
        rows = _pass(rows, digit)
    return rows
