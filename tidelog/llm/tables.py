"""Reading tables, running Arrow kernels in bounded batches, shared scratch tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.session import scratch_root

#: Rows and bytes of one Arrow batch, so that a worker's memory doesn't follow a partition's size.
BATCH_ROWS, BATCH_BYTES = 1_000, 16 << 20

#: ASCII white space; a word is a maximal run of other characters.
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(
    df: DataFrame,
    kernel: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: T.StructType | str,
) -> DataFrame:
    """``mapInArrow`` over batches of bounded rows and bytes."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(kernel, schema)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column's values, null as the empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """As ``texts``, in UTF-8."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share."""
    return f"{scratch_root(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a cut lineage that outlives executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc32_mod(column: str, divisor: int):
    """crc32 of the id's decimal text, modulo ``divisor``; null ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(divisor))
