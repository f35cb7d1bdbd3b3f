"""Spelling variants: words one edit apart, found by pivotal bigrams.

The bigrams of a word are put in one order for all words, rarest first.  Its *prefix* is the
first three, and all that equal the third; among them dynamic programming picks two that do not
overlap and are rarest together, its *pivots*.  One edit destroys at most one of two bigrams that do
not overlap.  So of two words one edit apart, the one whose prefix ends earlier in the order has a
pivot that stands in the other's prefix, at the same place or, if the lengths differ, moved by that one.
Prefixes are the index, pivots look up in it under bigram, place and length, and every
pair that meets is compared exactly.

Words of over ``SHORT`` code points use their two halves as pivots, so that a row is
copied a few times only, however long it is.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.tables import map_batches, stored

#: Edits between near words, code points of a bigram.
EDITS, GRAM = 1, 2
#: Least code points and occurrences of a word, and how many times as frequent its form is.
LEAST_POINTS, LEAST_COUNT, TIMES = 5, 3, 2
#: Words of more code points are looked up by their halves.
SHORT = 60
#: Words, and code points of them, on one side of a comparison; pairs held at a time.
TILE, TILE_POINTS, HELD = 2_048, 1 << 20, 1 << 21
#: Words that a task counts before it sends them on; code points of a text taken at a time.
COUNTED, PIECE = 1 << 19, 1 << 20

# In Latin-1: A-Z become a-z; a-z and U+00C0 to U+00FF stay; the rest is space.
_FOLD = bytes(c if 97 <= c <= 122 or c >= 0xC0 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def _runs_of(text: str) -> Counter:
    """Lower-cased letter runs of a text with their counts, in Latin-1; other code points only separate."""
    found, at, rest = Counter(), 0, b""
    while at < len(text):
        folded = rest + text[at : at + PIECE].encode("latin-1", "replace").translate(_FOLD)
        at += PIECE
        words = folded.split()
        # A run cut by the end of the piece goes on in the next one.
        rest = words.pop() if at < len(text) and words and not folded.endswith(b" ") else b""
        found.update(words)
    return found


def _slipped(word: bytes, prefix: int, every: int) -> bytes:
    """The word, without one code point if ``every`` divides the hash of id and word."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), prefix)
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(
    docs: DataFrame, every: int = 97, points: int = LEAST_POINTS, least: int = LEAST_COUNT, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``word`` and ``n``: words with ``points`` code points and ``least`` occurrences or more in all texts.

    Runs of letters, A-Z as a-z.  Slips are planted: a run loses a code point where ``every``
    divides the crc32 of its row's key, a colon and the run, the one that the hash names.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for at, text_ in zip(batch.column("_key").to_pylist(), batch.column("_text").to_pylist()):
                prefix = zlib.crc32(f"{'' if at is None else at}:".encode())
                for run, n in _runs_of(text_ or "").items():
                    word = _slipped(run, prefix, every)
                    if len(word) >= points:
                        total[word] += n
                if len(total) > COUNTED:
                    yield from _counted(total)
                    total.clear()
        yield from _counted(total)

    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    parts = map_batches(rows, kernel, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _counted(total: Counter) -> Iterator[pa.RecordBatch]:
    words = list(total)
    for k in range(0, len(words), 50_000):
        some = words[k : k + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode("latin-1") for w in some], pa.string()), pa.array([total[w] for w in some], pa.int64())],
            names=["word", "n"],
        )


def gram_order(words: DataFrame) -> dict[bytes, tuple[int, int]]:
    """Place in the common order, rarest first, and frequency of every bigram of short words.

    Letters are a-z and 64 others, so there are 8,100 bigrams at most, whatever the words.
    """
    starts = F.sequence(F.lit(1), F.length("word") - (GRAM - 1))
    grams = words.where(F.length("word") <= SHORT).select(F.explode(F.transform(starts, lambda i: F.substring("word", i, GRAM))).alias("gram"))
    counts = sorted((n, gram) for gram, n in grams.groupBy("gram").agg(F.count(F.lit(1))).collect())
    return {gram.encode("latin-1"): (k, n) for k, (n, gram) in enumerate(counts)}


def pivots(prefix: list[tuple[int, int]], weight: list[int], count: int = EDITS + 1) -> tuple[tuple[int, int], ...]:
    """``count`` bigrams of the prefix that do not overlap and have the least total weight.

    ``prefix`` holds (bigram, place) by place.  ``best[c][j]``: the best choice of c among the first j.
    """
    places = [at for _, at in prefix]
    best: list[list[tuple | None]] = [[(0, ())] * (len(prefix) + 1)]
    for _ in range(count):
        row: list[tuple | None] = [None]
        for gram, at in prefix:
            before = best[-1][bisect_right(places, at - GRAM)]
            take = before and (before[0] + weight[gram], (*before[1], (gram, at)))
            row.append(min((x for x in (row[-1], take) if x), default=None))
        best.append(row)
    return best[-1][-1][1]


def _short_entries(word: bytes, order: dict[bytes, tuple[int, int]], weight: list[int]) -> Iterator[tuple[int, bool, int]]:
    """(cell, looks up, end of the prefix) for a word's places in the index and for its look-ups."""
    size = len(word)
    grams = sorted((order[word[i : i + GRAM]][0], i) for i in range(size - GRAM + 1))
    last = grams[GRAM * EDITS][0]
    prefix = sorted((g for g in grams if g[0] <= last), key=lambda g: g[1])
    cell = lambda gram, at, n: (gram * 64 + at) * 64 + n
    for gram, at in prefix:
        yield cell(gram, at, size), False, last
    for gram, at in pivots(prefix, weight):
        # The other word: as long, with the bigram at the same place; or one longer or shorter, before or behind the edit.
        yield cell(gram, at, size), True, last
        yield cell(gram, at, size + 1), True, last
        yield cell(gram, at + 1, size + 1), True, last
        yield cell(gram, at, size - 1), True, last
        if at:
            yield cell(gram, at - 1, size - 1), True, last


def _long_entries(word: bytes) -> Iterator[tuple[int, bool, int]]:
    """As above by halves: one edit leaves the first or the last half of the other word whole."""
    from xxhash import xxh64_intdigest as digest

    cell = lambda side, n, part: -1 - (digest(part, 2 * n + side) >> 1)
    size = len(word)
    yield cell(0, size, word[: size // 2]), False, 0
    yield cell(1, size, word[size // 2 :]), False, 0
    for other in (size - 1, size, size + 1):
        yield cell(0, other, word[: other // 2]), True, 0
        yield cell(1, other, word[size - (other - other // 2) :]), True, 0


def _entries(words: DataFrame, order: dict[bytes, tuple[int, int]]) -> DataFrame:
    """``cell``, ``probe``, ``last``, ``word`` (Latin-1) and ``n``: index rows and look-ups."""
    weight = [n for _, n in sorted(order.values())]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                raw = word.encode("latin-1")
                # Words on both sides of the limit may be near: the shorter ones are looked up by halves too.
                if len(raw) <= SHORT:
                    rows += [(*x, raw, n) for x in _short_entries(raw, order, weight)]
                if len(raw) >= SHORT:
                    rows += [(*x, raw, n) for x in _long_entries(raw)]
            if rows:
                cell, probe, last, raws, counts = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cell, pa.int64()),
                        pa.array(probe, pa.bool_()),
                        pa.array(last, pa.int32()),
                        pa.array(raws, pa.binary()),
                        pa.array(counts, pa.int64()),
                    ],
                    names=["cell", "probe", "last", "word", "n"],
                )

    return map_batches(words, kernel, "cell long, probe boolean, last int, word binary, n long")


def _letters(chars: np.ndarray) -> np.ndarray:
    """64 bits of each word: for 32 classes of letters, whether it has one, and two or more of them.

    An edit changes two classes' counts by one at most, so two bits at most.
    """
    n = len(chars)
    slot = np.arange(n)[:, None] * 32 + (chars & 31)
    counts = np.bincount(slot.ravel(), minlength=32 * n).reshape(n, 32)
    bits = np.concatenate([counts > 0, counts > 1], axis=1)
    return np.packbits(bits, axis=1).view(np.uint64).ravel()


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of a and b, as long or b one longer, differ by exactly one edit."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    size = a.shape[1]
    wide = np.ones((len(a), 1), bool)  # stops the run of equal letters behind the last one
    ahead = np.argmax(np.concatenate([a != b[:, :size], wide], axis=1), axis=1)
    behind = np.argmax(np.concatenate([(a != b[:, 1:])[:, ::-1], wide], axis=1), axis=1)
    return ahead + behind >= size


def near_pairs(index: list[bytes], index_last: np.ndarray, probes: list[bytes], probe_last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions in ``index`` and ``probes`` of words one edit apart, if the probe's prefix ends no later."""
    sides = []
    for words in (index, probes):
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        side = {}
        for size in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == size)
            chars = np.frombuffer(b"".join(words[k] for k in own.tolist()), np.uint8).reshape(len(own), size)
            side[size] = own, chars, _letters(chars)
        sides.append(side)
    for size, (left, a, a_bits) in sides[0].items():
        for other in (size - 1, size, size + 1):
            if other not in sides[1]:
                continue
            right, b, b_bits = sides[1][other]
            step = max(1, HELD // len(left))
            for k in range(0, len(right), step):
                near = np.bitwise_count(a_bits[:, None] ^ b_bits[None, k : k + step]) <= 2 * EDITS
                near &= index_last[left][:, None] >= probe_last[right[k : k + step]][None, :]
                i, j = np.nonzero(near)
                j += k
                some = max(1, (4 << 20) // max(size, 1))
                for s in range(0, len(i), some):
                    x, y = i[s : s + some], j[s : s + some]
                    good = _one_edit(a[x], b[y]) if size <= other else _one_edit(b[y], a[x])
                    if good.any():
                        yield left[x[good]], right[y[good]]


def near_links(words: DataFrame) -> DataFrame:
    """``a``, ``b``, ``n_a``, ``n_b``: each pair of words one edit apart once, a before b."""
    order = gram_order(words)
    entries = stored(_entries(words, order), "entries")
    tiles = lambda of: F.ceil(
        F.greatest(F.count_if(of) / TILE, F.sum(F.when(of, F.octet_length("word"))) / TILE_POINTS)
    ).cast("int")
    cells = entries.groupBy("cell").agg(tiles(~F.col("probe")).alias("held"), tiles(F.col("probe")).alias("asked"))
    # A cell with one side only has nothing to compare.
    met = entries.join(cells.where("held > 0 and asked > 0"), "cell")
    # An index row meets all tiles of look-ups, a look-up all tiles of the index.
    own = F.pmod(F.xxhash64("word"), F.when(F.col("probe"), F.col("asked")).otherwise(F.col("held"))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("probe"), F.col("held")).otherwise(F.col("asked")) - 1))
    met = met.withColumn("own", own).withColumn("other", other)
    part = F.when(F.col("probe"), F.struct("other", "own")).otherwise(F.struct(F.col("own").alias("other"), F.col("other").alias("own")))
    dealt = met.select(F.xxhash64("cell", part).alias("tile"), "probe", "last", "word", "n")
    dealt = dealt.repartition("tile").sortWithinPartitions("tile", "probe")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _tiles(batches):
            tile, probe, last, n = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("tile", "probe", "last", "n"))
            words = rows.column("word").to_pylist()
            edges = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1], True]).tolist()
            found = {}
            for s, e in zip(edges, edges[1:]):
                cut = s + int(np.searchsorted(probe[s:e], True))
                for i, j in near_pairs(words[s:cut], last[s:cut], words[cut:e], last[cut:e]):
                    for x, y in zip((s + i).tolist(), (cut + j).tolist()):
                        a, b = (x, y) if words[x] < words[y] else (y, x)
                        found[words[a], words[b]] = n[a], n[b]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([pair[k].decode("latin-1") for pair in found], pa.string()) for k in (0, 1)]
                    + [pa.array([counts[k] for counts in found.values()], pa.int64()) for k in (0, 1)],
                    names=["a", "b", "n_a", "n_b"],
                )

    return map_batches(dealt, kernel, "a string, b string, n_a long, n_b long").distinct()


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut where a tile ends; a tile is bounded on both sides."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        tile = batch.column("tile").to_numpy()
        cut = int(np.argmax(tile == tile[-1]))
        if cut or (rest and rest[-1].column("tile")[-1].as_py() != tile[0]):
            if rest or cut:
                yield pa.concat_batches([*rest, batch.slice(0, cut)])
            rest = []
        rest.append(batch.slice(cut))
    if rest:
        yield pa.concat_batches(rest)


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` for rows of ``word`` and ``form``: pointers doubled until none moves.

    A form has twice the count of its word, so chains are short and have no cycle.
    """
    at = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not at.where("moved").isEmpty():
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = at.join(ahead, "root", "left")
        at = stored(jumped.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
    return at.select("word", "root")


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """``word``, ``n``, ``form``, ``form_n``, ``root`` and ``n_near`` of each row of ``word``, ``n``.

    Words are distinct, of five letters or more.  A word's form is its near word of largest n,
    ties by code points, if that is ``times`` the word's n or more; its root is where forms lead.
    """
    words = stored(words, "words")
    links = stored(near_links(words), "near")
    near = links.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("m")).union(
        links.select("b", "a", "n_a")
    )
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    has_form = -F.col("best.m") >= times * F.col("n")
    rows = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("best.near")).alias("form"),
        F.when(has_form, -F.col("best.m")).alias("form_n"),
    )
    rows = stored(rows, "forms")
    found = rows.join(_roots(rows.where("form is not null")), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_variants(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``variants`` of the words of all texts.

    Null, empty and blank texts have no words; a null key hashes as the empty text; repeated rows
    count again; texts are read in pieces, so their length bounds nothing; columns but
    ``text`` and ``key`` are not read; an empty table gives no rows.
    """
    return variants(word_counts(docs, text=text, key=key))
