"""Counts and extremes from Parquet footers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_V1 = "spark.sql.sources.useV1SourceList"
_PUSHED = "spark.sql.parquet.aggregatePushdown"


def footer_figures(spark: SparkSession, paths: Sequence[str], schema: T.StructType, columns: Sequence[str]) -> DataFrame:
    """``rows`` and, for each of ``columns``, ``min_...`` and ``max_...``, as one row.

    They are pushed into the scan, which answers from the statistics in the file footers: no
    row group is read, so the cost follows the number of files.  Columns are whole numbers,
    floats, booleans or dates; statistics of text and timestamps are not exact enough for it.
    """
    allowed = (T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.DateType, T.BooleanType, T.FloatType, T.DoubleType)
    for name in columns:
        if not isinstance(schema[name].dataType, allowed):
            raise ValueError(f"{name} has no exact extremes in a footer")
    wanted = [F.count(F.lit(1)).alias("rows")]
    for name in columns:
        wanted += [F.min(name).alias(f"min_{name}"), F.max(name).alias(f"max_{name}")]
    if not paths:
        return spark.createDataFrame([], schema).agg(*wanted)
    # Only the newer reader takes aggregates; which one a path gets is settled here.
    spark.conf.set(_PUSHED, "true")
    known = spark.conf.get(_V1)
    spark.conf.set(_V1, ",".join(s for s in known.split(",") if s.strip() != "parquet"))
    try:
        return spark.read.schema(schema).parquet(*paths).agg(*wanted)
    finally:
        spark.conf.set(_V1, known)
