"""Session settings shared by all jobs."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Event dates are UTC calendar dates, so the session time zone is pinned.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles a method above 8000 bytes of bytecode.  A stage whose
    # generated code is larger (JSON parsing with many fields) would run
    # interpreted; below this limit Spark falls back to per-operator code instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.compression.codec": "zstd",
    # Silver has one sorted file per bucket: trust the order instead of sorting again.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    "spark.sql.streaming.metricsEnabled": "true",
    "spark.sql.streaming.minBatchesToRetain": "20",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str, conf: dict[str, str] | None = None) -> SparkSession:
    """Session with the shared settings; ``conf`` adds to or overrides them."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only where that is unset,
    as in local tests, is a temporary folder of this machine used.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="tidelog-")
