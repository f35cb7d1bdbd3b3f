"""SimHash near-duplicates: pivot distance tables between fingerprints.

A fingerprint's Hamming distances to a set of reference fingerprints are its
coordinates.  By the triangle inequality two fingerprints within r bits differ by at
most r in every coordinate, so a pair is dropped as soon as one differs by more; what
is left is compared bit by bit.

Coordinates alone would have every pair looked at.  Fingerprints therefore first
meet in buckets: cut into r + 2 blocks, two of them within r bits agree in at least
two blocks, so the pairs of blocks are the buckets' keys and no pair is lost.  Large
buckets are cut into tiles, and pairs of tiles are compared apart.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.components import components
from tidelog.llm.tables import map_batches, raw_texts, stored

#: Seed of the shingle hash, XXH64.
HASH_SEED = 42
#: Reference fingerprints; the same ones for every input.
PIVOTS = np.array([random.Random(1000 + k).getrandbits(64) for k in range(32)], np.uint64)
#: Fingerprints of one bucket that are compared in one piece.
TILE = 512


def _fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes."""
    votes = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 50_000):
        some = hashes[k : k + 50_000]
        bits = np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(0, dtype=np.uint32)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)[0])


def _shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words joined by spaces; of the whole sequence if it is shorter."""
    from xxhash import xxh64_intdigest as digest

    if not words:
        return np.empty(0, np.uint64)
    joined, n = b" ".join(words), len(words)
    if n <= size:
        return np.array([digest(joined, HASH_SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = [0, *ends[: n - size].tolist()]
    stops = (ends[size - 1 :] - 1).tolist()
    return np.array([digest(joined[i:j], HASH_SEED) for i, j in zip(starts, stops)], np.uint64)


def fingerprints(docs: DataFrame, words: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key`` and ``fingerprint`` (a long) of each row, over shingles of ``words`` words, repeats included.

    A-Z count as a-z.  A null, empty or blank text has fingerprint 0.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_fingerprint(_shingle_hashes(x.lower().split(), words)) for x in raw_texts(batch, "_text")]
            made = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(made)], names=[key, "fingerprint"])

    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()
    return map_batches(rows, kernel, f"`{key}` {kind}, fingerprint long")


def _coordinates(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values[:, None] ^ PIVOTS[None, :])


def _pairs_within(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions i < j of values (at most two tiles) that differ in ``radius`` bits or fewer."""
    table = _coordinates(values).astype(np.int16)
    order = np.argsort(table[:, 0], kind="stable")
    first = table[order, 0]
    stop = np.searchsorted(first, first + radius, side="right")
    count = stop - np.arange(len(order)) - 1
    i = np.repeat(np.arange(len(order)), count)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
    i, j = order[i], order[j]
    for k in range(1, len(PIVOTS)):
        near = np.abs(table[i, k] - table[j, k]) <= radius
        i, j = i[near], j[near]
        if k == 8 and len(i) < 1000:
            break  # few are left: comparing them is no dearer than more coordinates
    near = np.bitwise_count(values[i] ^ values[j]) <= radius
    return i[near], j[near]


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest position in the group of each of n positions, by the given links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label, new)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _block_masks(radius: int) -> list[int]:
    """Masks of all pairs of radius + 2 blocks of a fingerprint."""
    cuts = [round(64 * k / (radius + 2)) for k in range(radius + 3)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return [signed(a | b) for a, b in combinations(blocks, 2)]


def fingerprint_links(nodes: DataFrame, radius: int = 3) -> DataFrame:
    """Links ``a``, ``b`` that join what is within ``radius`` bits, from ``node`` and distinct ``fingerprint``.

    In each tile a group of n linked fingerprints gives n - 1 links, which reach as far
    as all of its pairs would.
    """
    keys = nodes.select(
        "node",
        "fingerprint",
        F.posexplode(F.array(*[F.col("fingerprint").bitwiseAND(F.lit(m)) for m in _block_masks(radius)])).alias("mask", "part"),
    )
    sizes = keys.groupBy("mask", "part").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = keys.join(sizes, ["mask", "part"]).withColumn("tiles", F.ceil(F.col("size") / TILE).cast("int"))
    own = F.pmod(F.xxhash64("fingerprint", F.lit(7)), F.col("tiles")).cast("int")
    met = met.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    bucket = F.xxhash64("mask", "part", F.least("own", "other"), F.greatest("own", "other"))
    met = met.select(bucket.alias("bucket"), "node", "fingerprint")
    dealt = met.repartition("bucket").sortWithinPartitions("bucket", "node")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches):
            bucket, node = rows[0], rows[1]
            edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
            a, b = [], []
            for s, e in zip(edges[:-1], edges[1:]):
                i, j = _pairs_within(rows[2][s:e].view(np.uint64), radius)
                if len(i):
                    label = _forest(e - s, i, j)
                    own = np.flatnonzero(label != np.arange(e - s))
                    a.append(node[s + label[own]])
                    b.append(node[s + own])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return map_batches(dealt, kernel, "a long, b long")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of whole runs of the first column, from sorted batches; a run is a tile pair at most."""
    rest: list[np.ndarray] | None = None
    for batch in batches:
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if rest is not None:
            now = [np.concatenate(x) for x in zip(rest, now)]
        if not len(now[0]):
            continue
        cut = int(np.searchsorted(now[0], now[0][-1]))
        if cut:
            yield [c[:cut] for c in now]
        rest = [c[cut:] for c in now]
    if rest is not None and len(rest[0]):
        yield rest


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``fingerprint`` and ``component_id`` of each row.

    Rows whose fingerprints differ in ``radius`` bits or fewer are linked; the component
    is the smallest key that links reach, the row's own included.  Keys are longs; rows
    without a key never name a component.  Equal fingerprints are one node, so copies
    cost a row each and no pairs.
    """
    marks = stored(
        fingerprints(docs, words, text, key).select(F.col(f"`{key}`").alias("id"), "fingerprint"), "fingerprints"
    )
    nodes = marks.groupBy("fingerprint").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("rows"))
    nodes = stored(nodes, "nodes")
    joined = components(fingerprint_links(nodes.select("node", "fingerprint").where("node is not null"), radius))
    # A fingerprint of one row without links is its own component and needs no lookup.
    named = (
        nodes.join(joined, "node", "left")
        .where("component is not null or rows > 1")
        .select("fingerprint", F.coalesce("component", "node").alias("component"))
    )
    return marks.join(named, "fingerprint", "left").select(
        F.col("id").alias(key), "fingerprint", F.coalesce("component", "id").alias("component_id")
    )


def keep_one(docs: DataFrame, words: int = 3, radius: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each group of rows whose fingerprints links join: that with the smallest key; the others go.

    Links are those of :func:`near_duplicates`.  Rows of one key are told apart by their texts: each
    is in the group of its own fingerprint, and where several of a group share its smallest key the one with
    the smallest digest of its text stays.  Equal rows leave one; of rows with equal key and text but other columns one stays, that which is
    smallest in its columns as JSON.  Rows without a key stay.  All columns are kept, whatever
    their names.  An empty table gives no rows.
    """
    said = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    # The row travels as one column, so no name of its own meets one of ours.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{key}`").cast("long").alias("id"),
        F.unhex(F.sha2(said, 256)).alias("digest"),
    )
    once = rows.where("id is not null").withColumn(
        "nth", F.row_number().over(Window.partitionBy("id", "digest").orderBy(F.to_json("row")))
    )
    once = once.where("nth = 1").drop("nth")
    marks = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")).where("id is not null")
    marks = stored(_digests(marks, words), "marks")
    values = stored(marks.select(F.col("fingerprint").alias("node"), "fingerprint").distinct(), "values")
    joined = components(fingerprint_links(values, radius)).withColumnRenamed("node", "fingerprint")
    placed = marks.join(joined, "fingerprint", "left").withColumn("group", F.coalesce("component", "fingerprint"))
    heads = placed.groupBy("group").agg(F.min(F.struct("id", "digest")).alias("x"))
    kept = heads.select("x.id", "x.digest")
    single = once.join(stored(kept, "kept").hint("merge"), ["id", "digest"], "left_semi")
    return single.select("row.*").unionByName(rows.where("id is null").select("row.*"))


def _digests(rows: DataFrame, words: int) -> DataFrame:
    """``id``, ``fingerprint`` and SHA-256 ``digest`` of the text of each row of ``id``, ``text``."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = raw_texts(batch)
            found = [_fingerprint(_shingle_hashes(x.lower().split(), words)) for x in raws]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(np.array(found, np.uint64).view(np.int64)),
                    pa.array([hashlib.sha256(x).digest() for x in raws], pa.binary()),
                ],
                names=["id", "fingerprint", "digest"],
            )

    return map_batches(rows, kernel, "id long, fingerprint long, digest binary")
