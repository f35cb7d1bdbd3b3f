"""MinHash near-duplicates: universal hash minima in bands, signatures, whole shingle sets.

A text's set of shingles is summarised by the minima of ``BANDS * BAND_ROWS`` hash functions
of a universal family.  Texts that agree in all minima of a band share its bucket.  A pair
that meets in a bucket must agree in ``LEAST_EQUAL`` minima, and then have the similarity in its whole sets.
Large-star and small-star turn links into components.

No bucket is expanded into all its pairs.  Its *hub*, the text that meets most others over all
buckets, is compared with every member first.  Only members that this leaves in different
components are compared with each other, in tile pairs, so a large group of copies costs
about a row per member and bucket.

Two texts of similarity 0.8 share no bucket once in 1.6 million times, and agree in fewer than
``LEAST_EQUAL`` minima about as rarely; every higher similarity is safer.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.stars import components
from tidelog.llm.tables import map_batches, raw_texts, stored

#: Words of a shingle and least similarity in per cent.
WORDS, PERCENT = 5, 80
#: Bands of minima, minima of a band, and minima in which a pair has to agree: at a similarity of
#: 0.8 (144 expected of 180) fewer than 114 do about once in ten million times.
BANDS, BAND_ROWS, LEAST_EQUAL = 36, 5, 114
#: Texts, and shingles of them, in a tile of a bucket.
TILE, TILE_SHINGLES = 128, 1 << 18
#: Bytes of a text that are cut into words, and shingles that are hashed, at a time.
PIECE, HASHED = 1 << 20, 512

_RANDOM = random.Random(20_240_611)
#: h(x) = (a x + b mod 2^64) >> 32 is a universal family over 32-bit x; these are its members.
_A = np.array([_RANDOM.getrandbits(64) | 1 for _ in range(BANDS * BAND_ROWS)], np.uint64)[:, None]
_B = np.array([_RANDOM.getrandbits(64) for _ in range(BANDS * BAND_ROWS)], np.uint64)[:, None]
_ODD = np.uint64(0x9E3779B97F4A7C15)
_HALF = np.uint64(32)
_WHITE = re.compile(rb"[ \t\n\x0b\x0c\r]")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _HALF)) * _ODD
    return x ^ (x >> np.uint64(29))


def _word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text, A-Z as a-z."""
    from xxhash import xxh64_intdigest as digest

    parts, at = [np.empty(0, np.uint64)], 0
    while at < len(raw):
        end = _WHITE.search(raw, at + PIECE) if at + PIECE < len(raw) else None
        stop = end.start() if end else len(raw)
        words, at = raw[at:stop].lower().split(), stop
        parts.append(np.fromiter(map(digest, words), np.uint64, len(words)))
    return np.concatenate(parts)


def shingle_set(raw: bytes, words: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words; of the whole sequence if it is shorter."""
    each = _word_hashes(raw)
    size = min(words, len(each))
    if not size:
        return np.empty(0, np.int64)
    n = len(each) - size + 1
    made = _mixed(each[:n] + np.uint64(size))
    for k in range(1, size):
        made = _mixed(made + each[k : n + k])
    return np.unique(made.view(np.int64))


def _digest(shingles: np.ndarray) -> bytes:
    """Names a set: 128 bits."""
    return hashlib.sha256(shingles.tobytes()).digest()[:16]


def _minima(shingles: np.ndarray) -> np.ndarray:
    x = shingles.view(np.uint64) >> _HALF
    lowest = np.full((len(_A), 1), np.iinfo(np.uint64).max)
    for k in range(0, len(x), HASHED):
        lowest = np.minimum(lowest, (_A * x[None, k : k + HASHED] + _B).min(1, keepdims=True))
    return (lowest >> _HALF).ravel()


def _band_keys(minima: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDS, dtype=np.uint64)
    for row in minima.reshape(BANDS, BAND_ROWS).T:
        keys = _mixed(keys * _ODD + row)
    return keys.view(np.int64)


def sketches(rows: DataFrame, words: int) -> DataFrame:
    """``id``, ``digest`` of the shingle set (null if empty), its ``size``, 16 bits of each of its ``minima``, band ``keys``."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for raw in raw_texts(batch):
                found = shingle_set(raw, words)
                if len(found):
                    minima = _minima(found)
                    made.append((_digest(found), len(found), minima.astype(np.uint16).tobytes(), _band_keys(minima)))
                else:
                    made.append((None, 0, None, np.empty(0, np.int64)))
            kinds = [pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(x, kind) for x, kind in zip(zip(*made), kinds))],
                names=["id", "digest", "size", "minima", "keys"],
            )

    return map_batches(rows, kernel, "id long, digest binary, size long, minima binary, keys array<long>")


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """``node`` (digest) and ``shingles`` of each row."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(raw, words) for raw in raw_texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_digest(x) for x in found], pa.binary()), pa.array(found, pa.list_(pa.int64()))],
                names=["node", "shingles"],
            )

    return map_batches(rows, kernel, "node binary, shingles array<long>")


def _lists(column: pa.Array) -> list[np.ndarray]:
    """Views of the lists of a column."""
    values, at = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[s:e] for s, e in zip(at[:-1], at[1:])]


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), BANDS * BAND_ROWS)


def _alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union of two sorted sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    both = int(np.count_nonzero(large[np.minimum(at, len(large) - 1)] == small))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _signed_alike(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those of the pairs ``a``, ``b`` whose signatures agree in enough minima."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                equal = (_signatures(batch.column("of_a")) == _signatures(batch.column("of_b"))).sum(1)
                yield batch.select(["a", "b"]).filter(pa.array(equal >= LEAST_EQUAL))

    of = lambda c: nodes.select(F.col("node").alias(c), F.col("minima").alias(f"of_{c}"))
    return map_batches(pairs.join(of("b"), "b").join(of("a"), "a"), kernel, "a binary, b binary")


def _wholly_alike(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``a``, ``b`` whose whole sets have the similarity."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [_alike(x, y, percent) for x, y in zip(_lists(batch.column("of_a")), _lists(batch.column("of_b")))]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    of = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"of_{c}"))
    return map_batches(pairs.join(of("b"), "b").join(of("a"), "a"), kernel, "a binary, b binary")


def _open_cells(shared: DataFrame, hubs: DataFrame, joined: DataFrame) -> DataFrame:
    """``cell``, ``node``, ``held`` of all members of buckets that still hold several components.

    The hub has met all, and is left out.  Members of the bucket's largest component need
    not meet each other; the others are cut into tiles that meet one another and the tiles of the largest.
    """
    rest = shared.join(hubs, "key").where("node <> hub").select("key", "node", "size")
    known = joined.select("node", F.col("component").alias("held"))
    placed = stored(rest.join(known, "node", "left").withColumn("held", F.coalesce("held", "node")), "placed")
    parts = placed.groupBy("key", "held").agg(F.count(F.lit(1)).alias("n"))
    open_ = parts.groupBy("key").agg(F.max_by("held", "n").alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    # Stored, so that the join is one of two tables and Spark can deal a bucket of many members to several tasks.
    sides = placed.join(stored(open_.select("key", "main"), "open"), "key")
    sides = stored(sides.select("key", "node", "size", "held", (F.col("held") != F.col("main")).alias("other")), "sides")
    tiles = lambda of: F.ceil(
        F.greatest(F.count_if(of) / TILE, F.sum(F.when(of, F.col("size"))) / TILE_SHINGLES)
    ).cast("int")
    # Buckets with the same members are compared once.
    buckets = sides.groupBy("key").agg(
        F.bit_xor(F.xxhash64("node")).alias("one"),
        F.bit_xor(F.xxhash64("node", F.lit(7))).alias("two"),
        tiles(F.col("other")).alias("others"),
        tiles(~F.col("other")).alias("mains"),
    )
    buckets = buckets.groupBy("one", "two").agg(F.min(F.struct("key", "others", "mains")).alias("x")).select("x.*")
    own = lambda n: F.pmod(F.xxhash64("node", F.lit(7)), F.col(n)).cast("int")
    return (
        sides.join(buckets, "key")
        .withColumn("own", F.when(F.col("other"), own("others")).otherwise(F.col("others") + own("mains")))
        .withColumn("last", F.col("others") - 1 + F.when(F.col("other"), F.col("mains")).otherwise(0))
        .withColumn("to", F.explode(F.sequence(F.lit(0), F.col("last"))))
        .select("node", "held", F.xxhash64("key", F.least("own", "to"), F.greatest("own", "to")).alias("cell"))
    )


def _cell_links(cells: DataFrame, sketched: DataFrame, percent: int) -> DataFrame:
    """Links ``a``, ``b`` between different components, from all pairs of each cell: a forest of them."""
    dealt = cells.join(sketched, "node").select("cell", "node", "held", "minima", "shingles")
    dealt = dealt.repartition("cell").sortWithinPartitions("cell")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _cells(batches):
            cell, signed = rows.column("cell").to_numpy(), _signatures(rows.column("minima"))
            nodes, held, sets = rows.column("node").to_pylist(), rows.column("held").to_pylist(), _lists(rows.column("shingles"))
            edges = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1], True]).tolist()
            found = []
            for s, e in zip(edges, edges[1:]):
                top = {x: x for x in held[s:e]}

                def root(x: bytes, top: dict = top) -> bytes:
                    while top[x] != x:
                        x = top[x]
                    return x

                for i in range(s, e - 1):
                    equal = (signed[i] == signed[i + 1 : e]).sum(1)
                    for j in (i + 1 + np.flatnonzero(equal >= LEAST_EQUAL)).tolist():
                        x, y = root(held[i]), root(held[j])
                        if x != y and _alike(sets[i], sets[j], percent):
                            top[x] = y
                            found.append((nodes[i], nodes[j]))
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return map_batches(dealt, kernel, "a binary, b binary")


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut where a cell ends; a cell is two tiles at most."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cell = batch.column("cell").to_numpy()
        cut = int(np.argmax(cell == cell[-1]))
        if rest and (cut or rest[-1].column("cell")[-1].as_py() != cell[0]):
            yield pa.concat_batches([*rest, batch.slice(0, cut)])
            rest = []
        elif cut:
            yield pa.concat_batches([batch.slice(0, cut)])
        rest.append(batch.slice(cut))
    if rest:
        yield pa.concat_batches(rest)


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` and ``kept`` of each row.

    Rows whose sets of ``words``-word shingles have 100 * intersection >= ``percent`` * union are
    linked; the component is the smallest key that links reach, the row's own included, and kept is the
    row that has it.  Fewer words make one shingle; a null, empty or blank text has none and no
    links, not even to others like it.  Equal sets are one node, so copies cost a row each.
    Rows may share a key: each is linked by its own text.  A row without a key never names a
    component (its own is null if no key is reached, and it is kept then).  Other columns are not read.

    ``percent`` is 80 or more: bands are laid out for that.
    """
    if percent < 80:
        raise ValueError("bands are laid out for 80 per cent or more")
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    marks = stored(sketches(rows, words), "sketches")
    groups = marks.where("digest is not null").groupBy(F.col("digest").alias("node"))
    nodes = groups.agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("rows"), *(F.first(c).alias(c) for c in ("size", "minima", "keys"))
    )
    nodes = stored(nodes, "nodes")

    members = nodes.select("node", "size", F.explode("keys").alias("key"))
    buckets = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(members.join(buckets, "key"), "shared")
    met = shared.groupBy("node").agg(F.sum("n").alias("met"))
    hubs = shared.join(met, "node").groupBy("key").agg(F.max_by("node", F.struct("met", "node")).alias("hub"))
    hubs = stored(hubs, "hubs")
    stars = shared.join(hubs, "key").where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    stars = stored(_signed_alike(stars, nodes), "stars")

    # Whole sets of all texts that a bucket may still compare: read once, from the row with the smallest key.
    def sets_of(wanted: DataFrame) -> DataFrame:
        ids = nodes.join(wanted, "node", "left_semi").select("id").distinct()
        there = rows.join(ids, rows["id"].eqNullSafe(ids["id"]), "left_semi")
        return stored(_sets(there, words).dropDuplicates(["node"]), "shingles")

    ends = stars.select(F.col("a").alias("node")).union(stars.select("b")).distinct()
    links = stored(_wholly_alike(stars, sets_of(ends), percent), "links")
    joined = components(links)
    cells = stored(_open_cells(shared, hubs, joined), "cells")
    if not cells.isEmpty():
        sketched = nodes.select("node", "minima").join(sets_of(cells.select("node").distinct()), "node")
        more = stored(_cell_links(cells, sketched, percent), "more")
        if not more.isEmpty():
            joined = components(joined.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    linked = stored(nodes.select("node", "id").join(joined, "node"), "linked")
    least = linked.groupBy("component").agg(F.min("id").alias("component_id"))
    named = linked.join(least, "component").select(F.col("node").alias("digest"), "component_id")
    # Copies without other links; a text of one row and no links is its own component and needs no lookup.
    copies = nodes.where("rows > 1").join(joined, "node", "left_anti").select(F.col("node").alias("digest"), F.col("id").alias("component_id"))
    found = marks.select("id", "digest", "size").join(named.union(copies), "digest", "left")
    component = F.coalesce("component_id", "id")
    return found.select(
        F.col("id").alias(key),
        F.col("size").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, component.isNull()).alias("kept"),
    )
