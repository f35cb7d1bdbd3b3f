"""Repeated passages of 200 bytes or more, over all texts.

Sorting every suffix of a corpus by a cover of fixed offsets needs a record for two
thirds of its bytes.  The cover here is given by content instead: a string is sampled
where the hash is smallest among its first 64 positions.  Equal strings are sampled at
equal offsets, so like a difference cover it brings any two equal suffixes to a common sampled
position, with one sample in about 30 bytes.

1. Samples are named: by the phrase behind them, and by the whole stretch that holds
   every 200-byte string with this sample.  Names are sorted and
   neighbours compared.  A stretch that repeats settles all its strings; a phrase that
   does not repeat rules them out.
2. The remaining suffixes, where the phrase repeats but not the stretch, are named one
   by one by their 200 bytes, together with one example of each repeated stretch of
   that phrase; again sorted names are compared with their neighbours.

Names are 64-bit hashes.  They travel in packed blocks, one for each batch and part of
the hash range.  What repeats inside a batch is settled there and sends one example, and a
phrase that is frequent in a batch is dealt by stretch, so that no part collects it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tidelog.llm.tables import map_batches, raw_texts, stored

#: Length of a repeat; bytes hashed at a position; neighbours among which a sample is the smallest.
LENGTH, GRAM, SPAN = 200, 24, 64
#: Bytes from a string's sample that the string holds in any case.
PHRASE = LENGTH - SPAN + 1
#: Rows of a phrase in one batch from which they are dealt by stretch.
FREQUENT = 16
#: Parts of the hash range for each shuffle partition.
PARTS = 4

_TABLE = np.random.default_rng(3).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_POWER = {n: np.uint64(pow(_BASE, n, 2**64)) for n in (1, 2, 4, 8)}


def stretches(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First start, last start and sample of the runs of 200-byte strings that have one sample in common.

    A string's sample is the first smallest hash among its leading ``SPAN`` positions, so it
    depends on the string alone.  The text has ``LENGTH`` bytes at least.
    """
    n = len(raw) - GRAM + 1
    h = _TABLE[np.frombuffer(raw, np.uint8)]
    for size in (1, 2, 4):
        h = h[:-size] * _POWER[size] + h[size:]
    h = (h[:-8] * _POWER[8] + h[8:])[:n] * _POWER[8] + h[16 : 16 + n]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    low = h
    for step in (1, 2, 4, 8, 16, 32):
        low = np.minimum(low[:-step], low[step:])
    edge = np.zeros(SPAN - 1, np.uint64)
    high = np.concatenate([edge, low, edge])
    for step in (1, 2, 4, 8, 16, 32):
        high = np.maximum(high[:-step], high[step:])
    smallest = np.flatnonzero(high == h)  # somewhere, not for each string that holds it
    starts = np.arange(len(raw) - LENGTH + 1)
    low = low[: len(starts)]
    which = np.searchsorted(smallest, starts)
    while True:
        later = h[smallest[which]] != low
        if not later.any():
            break
        which[later] += 1
    first = np.flatnonzero(np.r_[True, which[1:] != which[:-1]])
    return first, np.r_[first[1:] - 1, len(starts) - 1], smallest[which[first]]


def _packed(part: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch | None:
    """One row for each part with its slice of every column as bytes."""
    if not len(part):
        return None
    order = np.argsort(part, kind="stable")
    part = part[order]
    edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
    columns = [c[order] for c in columns]
    blobs = [pa.array([c[i:j].tobytes() for i, j in zip(edges, edges[1:])], pa.binary()) for c in columns]
    return pa.RecordBatch.from_arrays(
        [pa.array(part[edges[:-1]].astype(np.int32)), *blobs], names=["part", *[f"c{k}" for k in range(len(columns))]]
    )


def _parts_of(batches: Iterator[pa.RecordBatch], kinds: list) -> Iterator[list[np.ndarray]]:
    """The columns of each part, from packed rows sorted by part."""
    number, held = None, []

    def joined():
        return [np.concatenate([np.frombuffer(row[k], kind) for row in held]) for k, kind in enumerate(kinds)]

    for batch in batches:
        rows = zip(*[batch.column(f"c{k}").to_pylist() for k in range(len(kinds))])
        for part, row in zip(batch.column("part").to_pylist(), rows):
            if part != number:
                if held:
                    yield joined()
                number, held = part, []
            held.append(row)
    if held:
        yield joined()


def _dealt(rows: DataFrame, parts: int) -> DataFrame:
    return rows.repartition(parts // PARTS or 1, "part").sortWithinPartitions("part")


_MARK = np.uint8(1)  # stands for a phrase that repeats elsewhere, and for nothing in the text
_TWICE = np.uint8(2)  # its own stretch is known to repeat
_SETTLED = np.uint8(4)  # only passes through
_APART = np.uint8(8)  # its phrase is frequent, so it is dealt by stretch


def _same_as_neighbour(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a sorted row equals the one before it, and the one after it."""
    equal = np.ones(max(0, len(columns[0]) - 1), bool)
    for c in columns:
        equal &= c[1:] == c[:-1]
    return np.r_[False, equal][: len(columns[0])], np.r_[equal, False][: len(columns[0])]


def _keys(phrase: np.ndarray, stretch: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """What a sample is dealt by."""
    return np.where((flags & _APART) > 0, phrase ^ (stretch * np.uint64(_BASE)), phrase)


def _sampled(rows: DataFrame, parts: int) -> DataFrame:
    """Packed samples: phrase, stretch, row, last start, starts before it, flags."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phrase, stretch, row, first, last = [], [], [], [], []
            for rid, raw in zip(batch.column("row").to_pylist(), raw_texts(batch)):
                if len(raw) < LENGTH:
                    continue
                for lo, hi, at in zip(*[x.tolist() for x in stretches(raw)]):
                    phrase.append(xxh3_64_intdigest(raw[at : at + PHRASE]))
                    stretch.append(xxh3_64_intdigest(raw[lo : hi + LENGTH]))
                    row.append(rid)
                    first.append(lo)
                    last.append(hi)
            if not row:
                continue
            phrase, stretch = np.array(phrase, np.uint64), np.array(stretch, np.uint64)
            row, first, last = np.array(row, np.int64), np.array(first, np.int32), np.array(last, np.int32)
            order = np.lexsort((stretch, phrase))
            phrase, stretch, row, first, last = [c[order] for c in (phrase, stretch, row, first, last)]
            before, after = _same_as_neighbour(phrase, stretch)
            flags = np.zeros(len(row), np.uint8)
            flags[before | after] = _TWICE
            flags[before] = _SETTLED  # the first of a repeated stretch goes on as its example
            starts = np.flatnonzero(np.r_[True, phrase[1:] != phrase[:-1]])
            size = np.diff(np.r_[starts, len(phrase)])
            frequent = np.repeat(size, size) >= FREQUENT
            flags[frequent & (flags != _SETTLED)] |= _APART
            marks = starts[size >= FREQUENT]
            columns = [
                np.r_[phrase, phrase[marks]],
                np.r_[stretch, np.zeros(len(marks), np.uint64)],
                np.r_[row, np.zeros(len(marks), np.int64)],
                np.r_[last, np.zeros(len(marks), np.int32)],
                np.r_[(last - first).astype(np.uint8), np.zeros(len(marks), np.uint8)],
                np.r_[flags, np.full(len(marks), _MARK)],
            ]
            key = _keys(columns[0], columns[1], columns[5])
            through = columns[5] == _SETTLED
            key[through] = columns[2][through].view(np.uint64)
            part = (key * np.uint64(_BASE) >> np.uint64(33)) % np.uint64(parts)
            made = _packed(part.astype(np.int64), columns)
            if made is not None:
                yield made

    return map_batches(rows, kernel, "part int, " + ", ".join(f"c{k} binary" for k in range(6)))


def _settle(packed: DataFrame) -> DataFrame:
    """``row``, ``first``, ``last``, ``kind``: 0 repeated, 1 to be looked at start by start, 2 both."""
    kinds = [np.uint64, np.uint64, np.int64, np.int32, np.uint8, np.uint8]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for phrase, stretch, row, last, back, flags in _parts_of(batches, kinds):
            key, first = _keys(phrase, stretch, flags), last - back.astype(np.int32)
            through = (flags & _SETTLED) > 0
            done = [row[through], first[through], last[through]]
            live = ~through
            key, phrase, stretch, row, first, last, flags = [c[live] for c in (key, phrase, stretch, row, first, last, flags)]
            order = np.lexsort((stretch, phrase, key))
            key, phrase, stretch, row, first, last, flags = [c[order] for c in (key, phrase, stretch, row, first, last, flags)]
            mark = (flags & _MARK) > 0
            before, after = _same_as_neighbour(key, phrase)
            repeated = before | after | ((flags & _APART) > 0) | ((flags & _TWICE) > 0)
            twin_before, twin_after = _same_as_neighbour(key, phrase, stretch)
            twin_before &= ~mark
            settled = (twin_before | (twin_after & ~mark) | ((flags & _TWICE) > 0)) & ~mark
            # One example of a repeated stretch meets the lone stretches of its phrase, if there may be any.
            group = np.cumsum(~before)
            classes = np.bincount(group, ~twin_before & ~mark, minlength=int(group[-1]) + 1 if len(group) else 0)
            dealt_apart = (flags & _APART) > 0
            marked = np.bincount(group, mark, minlength=len(classes)) > 0
            others = (classes[group] > 1) | dealt_apart | marked[group] if len(group) else np.empty(0, bool)
            example = settled & ~twin_before & others
            lone = repeated & ~settled & ~mark
            kind = np.where(example, 2, np.where(lone, 1, 0)).astype(np.int8)
            keep = settled | lone
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.r_[done[0], row[keep]]),
                    pa.array(np.r_[done[1], first[keep]]),
                    pa.array(np.r_[done[2], last[keep]]),
                    pa.array(np.r_[np.zeros(len(done[0]), np.int8), kind[keep]]),
                ],
                names=["row", "first", "last", "kind"],
            )

    return map_batches(packed, kernel, "row long, first int, last int, kind tinyint")


def _starts(rows: DataFrame, parts: int) -> DataFrame:
    """Packed names of the 200 bytes at every start that is looked at: name, row, start, whether it is known to repeat."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, owner, place = [], [], []
            ranges = batch.column("ranges").to_pylist()
            for rid, raw, found in zip(batch.column("row").to_pylist(), raw_texts(batch), ranges):
                for lo, hi in sorted({(x["first"], x["last"]) for x in found}):
                    names += [xxh3_64_intdigest(raw[i : i + LENGTH]) for i in range(lo, hi + 1)]
                    owner += [rid] * (hi + 1 - lo)
                    place += range(lo, hi + 1)
            if not names:
                continue
            names, owner, place = np.array(names, np.uint64), np.array(owner, np.int64), np.array(place, np.int32)
            order = np.argsort(names, kind="stable")
            names, owner, place = names[order], owner[order], place[order]
            before, after = _same_as_neighbour(names)
            known = (before | after).astype(np.uint8)
            # All but the first of equal strings are settled; they pass through by row.
            key = np.where(before, owner.view(np.uint64), names)
            known[before] = 2
            made = _packed(((key * np.uint64(_BASE) >> np.uint64(33)) % np.uint64(parts)).astype(np.int64), [names, owner, place, known])
            if made is not None:
                yield made

    return map_batches(rows, kernel, "part int, c0 binary, c1 binary, c2 binary, c3 binary")


def _settle_starts(packed: DataFrame) -> DataFrame:
    """``row``, ``first``, ``last`` of runs of starts whose 200 bytes repeat."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, owner, place, known in _parts_of(batches, [np.uint64, np.int64, np.int32, np.uint8]):
            through = known == 2
            done_owner, done_place = owner[through], place[through]
            names, owner, place, known = [c[~through] for c in (names, owner, place, known)]
            order = np.argsort(names, kind="stable")
            names, owner, place, known = names[order], owner[order], place[order], known[order]
            before, after = _same_as_neighbour(names)
            hit = before | after | (known > 0)
            owner, place = np.r_[done_owner, owner[hit]], np.r_[done_place, place[hit]]
            if not len(owner):
                continue
            order = np.lexsort((place, owner))
            owner, place = owner[order], place[order]
            new = np.r_[True, (owner[1:] != owner[:-1]) | (place[1:] > place[:-1] + 1)]
            start = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner[start]), pa.array(place[start]), pa.array(place[np.r_[start[1:], len(owner)] - 1])],
                names=["row", "first", "last"],
            )

    return map_batches(packed, kernel, "row long, first int, last int")


def _freed(spark) -> None:
    """Lets the driver drop exchanges that no plan holds any more; their files go with them."""
    spark.sparkContext._jvm.System.gc()


def repeated_starts(docs: DataFrame) -> DataFrame:
    """``row`` and ``ranges``, the starts (first, last) of 200-byte strings that also start elsewhere; of ``row``, ``text``."""
    spark = docs.sparkSession
    parts = PARTS * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = stored(_settle(_dealt(_sampled(docs, parts), parts)), "stretches")
    _freed(spark)
    asked = found.where("kind > 0").groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    rest = stored(_settle_starts(_dealt(_starts(docs.join(asked, "row"), parts), parts)), "starts")
    _freed(spark)
    every = found.where("kind in (0, 2)").select("row", "first", "last").union(rest)
    return every.groupBy("row").agg(F.collect_set(F.struct("first", "last")).alias("ranges"))


def _cut(raw: bytes, ranges: list[dict]) -> tuple[list[tuple[int, int]], bytes]:
    """The maximal runs of bytes under the strings, and the bytes left."""
    runs: list[list[int]] = []
    for lo, hi in sorted((r["first"], r["last"] + LENGTH) for r in ranges or ()):
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], hi)
        else:
            runs.append([lo, hi])
    kept, done = [], 0
    for lo, hi in runs:
        kept.append(raw[done:lo])
        done = hi
    return [tuple(r) for r in runs], b"".join([*kept, raw[done:]])


def remove(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``n_bytes``, ``n_removed``, ``spans`` (byte runs removed) and ``kept`` (the bytes left) of each row.

    A byte goes if a 200-byte string over it also starts anywhere else, in the same text or
    another.  A null text is empty; texts of under 200 bytes stay whole; equal rows remove
    each other if they are long enough.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.xxhash64("id", "text"))
    ranges = repeated_starts(rows.select("row", "text"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, spans, kept = [], [], []
            for raw, found in zip(raw_texts(batch), batch.column("ranges").to_pylist()):
                runs, left = _cut(raw, found)
                n.append(len(raw))
                spans.append([{"start": a, "end": b} for a, b in runs])
                kept.append(left)
            kinds = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(spans, kinds), pa.array(kept, pa.binary())],
                names=[key, "n_bytes", "spans", "kept"],
            )

    joined = rows.join(ranges, "row", "left").select("id", "text", "ranges")
    return map_batches(joined, kernel, f"`{key}` {kind}, n_bytes long, spans array<struct<start:int,end:int>>, kept binary")
