"""Corpus preparation: documents through the text operators, stage by stage.

Every stage reads all that its predecessor kept, as a written table, and all but
the last return the columns of ``documents``, whatever their names.  A null text is the empty text.
Rows without an id go only by what their own text says: the quality rules and the benchmark
stage decide by text or keep them, the near-copy stage keeps them.  Of equal rows, and of equal texts with
one id, the near-copy stage leaves one; different texts with one id are different documents to it, and
go together in the benchmark stage.  Texts are read whole.  An empty table passes through empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import byte_bpe, decontaminate, pii, quality_rules, simhash
from tidelog.llm.queries import rank_file
from tidelog.llm.tables import scratch_path, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that a quality rule rejects."""
    return quality_rules.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group that near fingerprints link (three words, three bits)."""
    return simhash.keep_one(docs, words=3, radius=3)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark passage."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts placeholders for personal data; keeps every document."""
    return pii.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds each text's ids and their number; the decoded ids are the text again."""
    return byte_bpe.with_ids(docs, *rank_file())


STAGES = [
    ("quality_rules", quality),
    ("simhash", near_copies),
    ("decontaminate", benchmark_leaks),
    ("pii", personal_data),
    ("byte_bpe", tokens),
]

#: The near-duplicate, PII and subword stages are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
