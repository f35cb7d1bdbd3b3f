"""Importance resampling towards a target distribution, by hashed word runs.

The runs of words of all documents and of all target texts are counted in hashed buckets.  A
bucket's gain is the logarithm of its share in the target against its share in the documents, a
document's weight the mean gain of its features, looked up in one array.  With Gumbel noise added,
the highest scores are a draw without replacement; a radix sort ranks them.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.radix import ranked
from tidelog.llm.tables import map_batches, raw_texts

#: Buckets, longest run of words, percent of the documents drawn, words a drawn document has at least, seed.
BUCKETS, RUN, PERCENT, LEAST_WORDS, SEED = 10_000, 1, 10, 20, 2024
#: Bytes of a text that are cut into words at a time.
PIECE = 1 << 20

# Digits, small letters and bytes of other scripts stay, A-Z become small, the rest is space.
_FOLD = bytes(
    c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)
_SPACE = re.compile(rb" ")


def _features(raw: bytes, run: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Number of words and buckets of the features, piece by piece of a text."""
    folded, at, tail = raw.translate(_FOLD), 0, []
    while at < len(folded):
        end = _SPACE.search(folded, at + PIECE) if at + PIECE < len(folded) else None
        stop = end.start() if end else len(folded)
        words, at = folded[at:stop].split(), stop
        joined, new, found = tail + words, len(tail), words
        for size in range(2, run + 1):
            starts = range(max(new - size + 1, 0), len(joined) - size + 1)
            found = found + [b" ".join(joined[i : i + size]) for i in starts]
        tail = joined[max(len(joined) - run + 1, 0) :] if run > 1 else []
        yield len(words), np.fromiter(map(zlib.crc32, found), np.int64, len(found)) % buckets


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS, run: int = RUN, text: str = "text") -> np.ndarray:
    """Features of all texts by bucket.  ``buckets`` bounds what reaches the driver."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for raw in raw_texts(batch, "_text"):
                for _, found in _features(raw, run, buckets):
                    np.add.at(total, found, 1)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["bucket", "n"])

    parts = map_batches(rows.select(F.col(f"`{text}`").alias("_text")), kernel, "bucket long, n long")
    counts = np.zeros(buckets, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():
        counts[bucket] = n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of each of B buckets."""
    size, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (s_all + size) / ((s + 1) * (t_all + size))))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def noise(key: int | None, seed: int = SEED) -> int:
    """Gumbel noise of a key, in thousandths, from the hash of seed and key."""
    h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(docs: DataFrame, gain: np.ndarray, run: int = RUN, seed: int = SEED, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``n_words``, ``n_features``, ``weight`` and ``score`` of each row."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at, raw in zip(batch.column("_key").to_pylist(), raw_texts(batch, "_text")):
                n_words = n = total = 0
                for words, found in _features(raw, run, len(gain)):
                    n_words, n, total = n_words + words, n + len(found), total + int(gain[found].sum())
                weight = total // n if n else 0
                rows.append((n_words, n, weight, weight + noise(at, seed)))
            made = np.array(rows, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), *(pa.array(np.ascontiguousarray(made[:, k])) for k in range(4))],
                names=["_key", "n_words", "n_features", "weight", "score"],
            )

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("_key"), F.col(f"`{text}`").alias("_text"))
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("_key", "n_words", "n_features", "weight", "score")])
    return map_batches(rows, kernel, schema).withColumnRenamed("_key", key)


def resample(
    docs: DataFrame,
    target: DataFrame,
    buckets: int = BUCKETS,
    run: int = RUN,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """``key``, ``n_features``, ``weight``, ``score`` and ``rank`` of each row of ``docs``; ``rank`` is null if not drawn.

    Of the rows with ``least_words`` words or more, the ``percent`` per cent with the highest
    scores are drawn (rounded down), ties by the smaller key, a null key last.  A null or empty text has no
    features and weight 0.  Rows with one key share their noise; with equal scores too they rank
    as they are read.  Other columns are not read; an empty table gives no rows, an empty target
    the same arithmetic with no target features.
    """
    gain = gains(bucket_counts(docs, buckets, run, text), bucket_counts(target, buckets, run, text))
    rows = weighted(docs, gain, run, seed, text, key).withColumn("_enough", F.col("n_words") >= least_words)
    # Those that cannot be drawn come after all others.
    rows = rows.withColumn("_out", F.when(F.col("_enough"), 0).otherwise(1).cast("long"))
    placed = ranked(rows, [("_out", False), ("score", True), (key, False)])
    drawn = placed.agg(F.count_if("_enough")).first()[0] * percent // 100
    rank = F.when(F.col("_enough") & (F.col("place") < drawn), F.col("place") + 1)
    return placed.select(key, "n_features", "weight", "score", rank.alias("rank"))
