"""Byte-level BPE: ranked merges folded over the bytes of distinct words.

Two forms with one result.  ``encode`` splits whole texts and folds each distinct
word of a task once.  ``fold_words`` is the same fold as Spark higher-order
functions over a table of words, with the ranks as one literal; the README has its
figures and why whole texts don't go that way.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.tables import map_batches, texts

#: Distinct words that a task remembers; beyond it the memory starts anew.
REMEMBERED_WORDS = 600_000
#: Bytes of a word from which a heap picks the next merge.
LONG_WORD = 48

_NEVER = 1 << 60


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The word's ids: again and again the leftmost pair of lowest rank becomes one piece."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > LONG_WORD:
        return _fold_long(word, ranks)
    pieces = [word[i : i + 1] for i in range(len(word))]
    pairs = [ranks.get(word[i : i + 2], _NEVER) for i in range(len(word) - 1)]
    while pairs:
        lowest = min(pairs)
        if lowest == _NEVER:
            break
        i = pairs.index(lowest)
        pieces[i : i + 2] = [pieces[i] + pieces[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(pieces[i - 1] + pieces[i], _NEVER)
        if i < len(pairs):
            pairs[i] = ranks.get(pieces[i] + pieces[i + 1], _NEVER)
    return [ranks[p] for p in pieces]


def _fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As ``fold``, in n log n: pieces are linked spans, candidate pairs wait in a heap."""
    n = len(word)
    end = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    alive = [True] * n
    waiting = [(ranks[word[i : i + 2]], i, i + 2) for i in range(n - 1) if word[i : i + 2] in ranks]
    heapq.heapify(waiting)

    def offer(i: int) -> None:
        right = end[i]
        if right < n and (rank := ranks.get(word[i : end[right]])) is not None:
            heapq.heappush(waiting, (rank, i, end[right]))

    while waiting:
        _, i, stop = heapq.heappop(waiting)
        right = end[i] if alive[i] else n
        if right >= n or end[right] != stop:
            continue  # one of its pieces has changed since
        alive[right] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


class Encoder:
    """Folds each distinct word once and remembers the ids as packed int32.

    Texts fall apart at single spaces first: what stands between two of them holds
    whole matches of the pattern, so its ids are looked up at once.  Where white space
    meets a space the whole text goes through the pattern.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.crowded = re.compile(r"\s \s").search
        self.vocabulary = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.vocabulary[rank] = token
        self.names = list(map(str, range(len(self.vocabulary))))
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = sorted(
            (ranks[token[:i]] << 32 | ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        )
        self.pair_keys = np.array([k for k, _ in pairs], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs], np.int64)
        self.words: dict[str, bytes] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], _NEVER)

    def _fold_many(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each word; a round joins one pair in every word that still has one."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), size)
        out: list[bytes] = [b""] * len(words)
        inner = word[1:] == word[:-1]
        rank = np.full(len(ids), _NEVER)
        at = np.flatnonzero(inner)
        rank[at] = self._rank(ids[at], ids[at + 1])
        while len(ids):
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, start)
            done = lowest == _NEVER
            if done.any():
                stop = np.r_[start[1:], len(ids)]
                packed = ids.astype(np.int32)
                for w, i, j in zip(word[start[done]], start[done], stop[done]):
                    out[w] = packed[i:j].tobytes()
                left = ~np.repeat(done, stop - start)
                ids, word, rank = ids[left], word[left], rank[left]
                if not len(ids):
                    break
                lowest = lowest[~done]
                start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low = np.repeat(lowest, np.diff(np.r_[start, len(ids)]))
            at = np.flatnonzero(rank == low)
            at = at[np.r_[True, word[at[1:]] != word[at[:-1]]]]
            ids[at] = rank[at]
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            at -= np.arange(len(at))  # the place of the joined piece after the removals before it
            ids, word, rank = ids[stay], word[stay], rank[stay]
            for i in (at, at[at > 0] - 1):
                i = i[i < len(ids) - 1]
                same = word[i] == word[i + 1]
                rank[i] = _NEVER
                i = i[same]
                rank[i] = self._rank(ids[i], ids[i + 1])
            rank[-1] = _NEVER
        return out

    def _learn(self, words: set[str]) -> None:
        short = []
        for word in words:
            raw = word.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                self.words[word] = np.int32(rank).tobytes()
            elif len(raw) > LONG_WORD:
                self.words[word] = np.array(_fold_long(raw, self.ranks), np.int32).tobytes()
            else:
                short.append((word, raw))
        for k in range(0, len(short), 20_000):
            some = short[k : k + 20_000]
            self.words.update(zip([w for w, _ in some], self._fold_many([r for _, r in some])))

    def batch(self, bodies: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self.words) > REMEMBERED_WORDS:
            self.words.clear()
        known, parts = self.words, []
        get = known.get
        missing: set[str] = set()
        for body in bodies:
            if "  " in body or self.crowded(body):
                found = self.split(body)
            else:
                found = body.split(" ")
                found[1:] = [" " + x for x in found[1:]]
            packed = list(map(get, found))
            if None in packed:
                missing.update([x for x, y in zip(found, packed) if y is None])
            parts.append((found, packed))
        pieces = {x: self.split(x) for x in missing}
        self._learn({p for found in pieces.values() for p in found if p not in known})
        for x, found in pieces.items():
            if x not in known:
                known[x] = b"".join([known[p] for p in found])
        out = []
        for found, packed in parts:
            if None in packed:
                packed = [known[x] if y is None else y for x, y in zip(found, packed)]
            out.append(np.frombuffer(b"".join(packed), np.int32))
        for x, found in pieces.items():
            for word in (x, *found):
                if len(word) > 2 * LONG_WORD:
                    known.pop(word, None)
        return out

    def decoded(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids.tolist()))

    def written(self, ids: np.ndarray) -> str:
        """The ids in decimal, joined by commas."""
        return ",".join(map(self.names.__getitem__, ids.tolist()))


_ENCODERS: dict[tuple[int, str], Encoder] = {}


def _encoder(ranks: dict[bytes, int], pattern: str) -> Encoder:
    """One per worker: consecutive tasks share what it remembers."""
    found = _ENCODERS.get(key := (hash(frozenset(ranks.items())), pattern))
    if found is None:
        _ENCODERS.clear()
        found = _ENCODERS[key] = Encoder(ranks, pattern)
    return found


def _encoded(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str, key: str, finish: Callable, columns: str) -> DataFrame:
    """``key`` and what ``finish`` makes of each batch of id arrays."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # as long as the vocabulary file

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value, pattern)
        for batch in batches:
            made = finish(encoder, encoder.batch(texts(batch, "_text")))
            yield pa.RecordBatch.from_arrays([batch.column("_key"), *made.values()], names=[key, *made])

    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()
    return map_batches(rows, kernel, f"`{key}` {kind}, {columns}")


def _lists(encoder: Encoder, ids: list[np.ndarray]) -> dict[str, pa.Array]:
    ends = np.cumsum([0, *map(len, ids)])
    flat = pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32))
    return {
        "token_ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat),
        "decoded": pa.array([encoder.decoded(x) for x in ids], pa.binary()),
    }


def _sums(encoder: Encoder, ids: list[np.ndarray]) -> dict[str, pa.Array]:
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return {
        "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
        "ids_sha256": pa.array([sha(encoder.written(x).encode()) for x in ids], pa.string()),
        "decoded_sha256": pa.array([sha(encoder.decoded(x)) for x in ids], pa.string()),
    }


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``token_ids`` and ``decoded`` (the ids' bytes) of each text.

    A null or empty text has no ids.  Rows are encoded one by one, so repeated keys
    stay repeated; other columns don't matter, whatever their names.
    """
    return _encoded(docs, ranks, pattern, text, key, _lists, "token_ids array<int>, decoded binary")


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """As ``encode``, but with the number of ids and the digests of ids and bytes; no text leaves its task."""
    columns = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _encoded(docs, ranks, pattern, text, key, _sums, columns)


def decode(tokens: DataFrame, ranks: dict[bytes, int], ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Adds the bytes of an id array: the ids' binary pieces, concatenated."""
    shared = tokens.sparkSession.sparkContext.broadcast(ranks)

    @F.pandas_udf("binary")
    def joined(column):
        vocabulary = {rank: token for token, rank in shared.value.items()}
        return column.map(lambda x: None if x is None else b"".join([vocabulary[i] for i in x]))

    return tokens.withColumn(out, joined(F.col(ids)))


def with_ids(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """The documents with ``token_ids`` and ``n_tokens``, their own columns untouched.

    A column of either name is replaced.  Each text is held against its decoded ids;
    the job fails if they differ.
    """
    added = ("token_ids", "n_tokens")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in added]).alias("_row")
    coded = encode(docs.select(row, F.col(f"`{text}`").alias("_text")).select(F.struct("_row", "_text").alias("_all"), "_text"), ranks, pattern, "_text", "_all")
    same = F.coalesce(F.col("_all._text"), F.lit("")).cast("binary") == F.col("decoded")
    checked = F.when(same, F.col("token_ids")).otherwise(
        F.raise_error(F.lit("ids do not decode to their text")).cast("array<int>")
    )
    return coded.select("_all._row", checked.alias("token_ids")).select(
        "_row.*", "token_ids", F.size("token_ids").cast("long").alias("n_tokens")
    )


_SLOTS = 1 << 16


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """The ranks as one literal: an array of slots, each with the tokens (in hex) whose hash falls there.

    A lookup in a literal map is a walk over all its entries; a slot has about one.
    """
    import json
    import zlib

    slots: list[list] = [[] for _ in range(_SLOTS)]
    for token, rank in ranks.items():
        slots[zlib.crc32(token.hex().upper().encode()) % _SLOTS].append({"t": token.hex().upper(), "r": rank})
    return F.from_json(F.lit(json.dumps(slots)), "array<array<struct<t:string,r:int>>>")


def fold_words(words: DataFrame, ranks: dict[bytes, int], word: str = "word") -> DataFrame:
    """Adds ``token_ids`` of each (distinct, not null) word with Spark's own higher-order functions.

    The state of the fold is the list of pieces in hex.  A step finds the lowest rank
    of all neighbouring pairs and joins the leftmost pair that has it; a word of n
    bytes takes n - 1 steps at most.
    """
    table = rank_literal(ranks)
    words = words.withColumn("_ranks", table).withColumn("_hex", F.hex(F.col(word).cast("binary")))

    def rank_of(piece: Column) -> Column:
        slot = F.get(F.col("_ranks"), F.pmod(F.crc32(piece.cast("binary")), F.lit(_SLOTS)).cast("int"))
        return F.get(F.filter(slot, lambda x: x["t"] == piece), F.lit(0))["r"]

    def step(pieces: Column, _: Column) -> Column:
        pairs = F.transform(
            F.sequence(F.lit(1), F.size(pieces) - 1),
            lambda i: F.struct(
                F.coalesce(rank_of(F.concat(F.get(pieces, i - 1), F.get(pieces, i))), F.lit(1 << 30)).alias("r"),
                i.cast("int").alias("i"),
            ),
        )
        best = lambda p: F.when(F.size(p) > 1, F.array_min(pairs))

        def joined(b: Column) -> Column:
            i = b["i"]
            return F.concat(
                F.slice(pieces, F.lit(1), i - 1),
                F.array(F.concat(F.get(pieces, i - 1), F.get(pieces, i))),
                F.slice(pieces, i + 2, F.size(pieces)),
            )

        return F.get(
            F.transform(
                F.array(best(pieces)),
                lambda b: F.when(b.isNull() | (b["r"] == (1 << 30)), pieces).otherwise(joined(b)),
            ),
            F.lit(0),
        )

    n = (F.length("_hex") / 2).cast("int")
    single = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substr(F.col("_hex"), i * 2 + 1, F.lit(2))))
    folded = words.withColumn("_bytes", single).withColumn(
        "_pieces",
        F.aggregate(F.sequence(F.lit(1), n), F.col("_bytes"), step),
    )
    return folded.withColumn("token_ids", F.transform("_pieces", rank_of)).drop("_ranks", "_hex", "_bytes", "_pieces")
