"""Benchmark passages in documents, also with other numbers, names and units.

A text's tokens become a template: numbers, names and units turn into typed
placeholders, whose values are kept as slots.  Windows of template tokens are joined
by hash with those of the benchmark.  Windows of a document and an item that lie on
one diagonal form a match if the slots are consistent: each value of the item stands
for one value of the document, and the other way round.

A second view of the same tokens has no placeholders, only lower-case words.  It finds
word-for-word passages whose capitals or digits are set differently.  A third one takes
capitalised words that open a sentence for names as well: "Anna has" and "Bob has" are one template.
Windows of all views on one diagonal add up to one match.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidelog.llm.tables import map_batches, stored, texts

#: Tokens of a window, and how many tokens of a match must not be placeholders.
WINDOW, LEAST_WORDS = 8, 5
#: Tokens in a row that make a match; a shorter item has to match whole.
LEAST_TOKENS = 13
#: Window hashes of the benchmark that a task holds at once (16 MB); a larger benchmark goes in blocks.
BLOCK = 1 << 21
#: Benchmark windows up to which the join sends them to all tasks (about 10 MB).
SENT_WINDOWS = 50_000

_TOKEN = re.compile(r"[^\W\d_]+|\d+(?:[.,]\d+)*|[.!?:\n]")
#: Marks of a token.
_STOP, _NUMBER, _UNIT, _CAPITAL = 1, 2, 4, 8
# Units, and numbers as words, in English, French, German and Spanish. Words with a
# common other sense (cent, once, null) are left out of the numbers.
_UNITS = frozenset(
    "km m cm mm kg g mg t l ml s ms min h hour hours minute minutes second seconds day days week weeks month months year years "
    "mile miles foot feet inch inches pound pounds ounce ounces gallon gallons litre litres liter liters metre metres meter meters "
    "dollar dollars euro euros cent cents percent degree degrees "
    "heure heures seconde secondes jour jours semaine semaines mois an ans mètre mètres gramme grammes livre livres centime centimes "
    "stunde stunden sekunde sekunden tag tage woche wochen monat monate jahr jahre pfund gramm "
    "hora horas minuto minutos segundo segundos día días dia dias semana semanas mes meses año años metro metros litro litros "
    "gramo gramos dólar dólares céntimo céntimos".split()
)
_NUMBERS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million "
    "zéro deux trois quatre cinq sept huit neuf dix onze douze treize quatorze quinze seize vingt trente quarante cinquante soixante "
    "cent mille "
    "null zwei drei vier fünf sechs sieben acht neun zehn elf zwölf dreizehn vierzehn fünfzehn sechzehn siebzehn achtzehn neunzehn "
    "zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig hundert tausend "
    "cero dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince dieciséis diecisiete dieciocho "
    "diecinueve veinte treinta cuarenta cincuenta sesenta setenta ochenta noventa cien ciento mil".split()
) - {"cent", "once", "null"}
_MULTIPLIERS = np.array([xxh64_intdigest(f"place {k}") | 1 for k in range(WINDOW)], np.uint64)


_KINDS = {k: np.uint64(xxh64_intdigest(f"<{k}>")) for k in ("number", "unit", "name")}
#: Distinct tokens that a task remembers; beyond it the memory starts anew.
_REMEMBERED = 400_000


def _scrambled(x: np.ndarray) -> np.ndarray:
    return x ^ (x >> np.uint64(29))


class _Tokens:
    """Number, hash (of the lower-case form) and marks of each distinct token."""

    def __init__(self):
        self._start()

    def _start(self):
        self.number: dict[str, int] = {}
        self.token: list[str] = []
        self.hash = np.empty(0, np.uint64)
        self.mark = np.empty(0, np.uint8)

    def learn(self, tokens: set[str]) -> None:
        if len(self.token) > _REMEMBERED:
            self._start()
        new = [t for t in tokens if t not in self.number]
        hashes, marks = [], []
        for t in new:
            low = t.lower()
            capital = len(t) > 1 and t[0].isupper() and t[1:].islower()
            hashes.append(xxh64_intdigest(low))
            marks.append(
                _STOP * (t in ".!?:\n")
                + _NUMBER * (t[0].isdigit() or low in _NUMBERS)
                + _UNIT * (low in _UNITS)
                + _CAPITAL * capital
            )
        self.number.update(zip(new, range(len(self.token), len(self.token) + len(new))))
        self.token += new
        self.hash = np.r_[self.hash, np.array(hashes, np.uint64)]
        self.mark = np.r_[self.mark, np.array(marks, np.uint8)]


def _hash_windows(each: np.ndarray, size: int) -> np.ndarray:
    total = np.zeros(max(0, len(each) - size + 1), np.uint64)
    mixed = _scrambled(each)
    for k in range(size):
        total += mixed[k : k + len(total)] * _MULTIPLIERS[k]
    return total ^ (total >> np.uint64(32)) ^ np.uint64(size)


def _batch_windows(bodies: list[str], memory: _Tokens):
    """For each view: its number and the place, size, hash of each window; then rows, row starts and sizes, a slot and a hole getter.

    Windows that are the same in two views come in the earlier one only.
    """
    split = [_TOKEN.findall(x) for x in bodies]
    memory.learn(set().union(*split) if split else set())
    get = memory.number.__getitem__
    ids = np.array([i for x in split for i in map(get, x)], np.int64)
    row = np.repeat(np.arange(len(split)), [len(x) for x in split])
    mark = memory.mark[ids]
    fresh = np.r_[True, row[1:] != row[:-1]] if len(row) else np.empty(0, bool)
    open_ = ~fresh & ~np.r_[True, (mark[:-1] & _STOP) > 0][: len(mark)]  # inside a sentence
    capital = (mark & _CAPITAL) > 0
    stay = (mark & _STOP) == 0
    ids, row, mark, capital, open_ = ids[stay], row[stay], mark[stay], capital[stay], open_[stay]
    number = (mark & _NUMBER) > 0
    same = np.r_[False, row[1:] == row[:-1]][: len(row)]
    unit = ((mark & _UNIT) > 0) & same & np.r_[False, number[:-1]][: len(row)] & ~number
    capital &= ~number & ~unit
    opening = capital & ~open_
    plain = memory.hash[ids]
    template = plain.copy()
    for which, kind in ((number, "number"), (unit, "unit"), (capital & open_, "name")):
        template[which] = _KINDS[kind]
    opened = template.copy()
    opened[opening] = _KINDS["name"]
    filled = {1: number | unit | (capital & open_), 2: number | unit | capital}
    sizes = np.bincount(row, minlength=len(split))
    first = np.cumsum(sizes) - sizes

    def slots(view: int, start: int, size: int) -> list[str]:
        kind = lambda i: "n" if number[i] else "u" if unit[i] else "p"
        return [f"{kind(i)}:{memory.token[ids[i]].lower()}" for i in range(start, start + size) if filled[view][i]]

    def holes(view: int, start: int, size: int) -> list[int]:
        return [i - int(first[row[start]]) for i in range(start, start + size) if filled[view][i]]

    found = []
    short = [int(r) for r in np.flatnonzero((sizes > 0) & (sizes < WINDOW))]
    for view, each, own in ((0, plain, None), (1, template, filled[1]), (2, opened, opening)):
        values = _hash_windows(each, WINDOW)
        whole = row[: len(values)] == row[WINDOW - 1 :][: len(values)]
        at, size = np.flatnonzero(whole), np.full(int(whole.sum()), WINDOW)
        values = values[at]
        if short:
            at = np.r_[at, first[short]]
            size = np.r_[size, sizes[short]]
            values = np.r_[values, [_hash_windows(each[first[r] : first[r] + sizes[r]], int(sizes[r]))[0] for r in short]]
        if own is not None:
            before = np.r_[0, np.cumsum(own)]
            usable = before[at + size] > before[at]
            at, size, values = at[usable], size[usable], values[usable]
        found.append((view, at, size, values.astype(np.uint64)))
    return found, row, first, sizes, slots, holes


_WINDOWS = "hash long, view int, pos int, n_tokens int, slots array<string>, holes array<int>"


def _windows(rows: DataFrame, only: np.ndarray | None = None) -> DataFrame:
    """``id``, ``hash``, ``view``, ``pos``, ``n_tokens``, ``slots``, ``holes`` (places of the slots) of the windows (those in the sorted ``only``)."""
    shared = None if only is None else rows.sparkSession.sparkContext.broadcast(only)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Tokens()
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int32()))
        for batch in batches:
            found, row, first, sizes, slots, holes = _batch_windows(texts(batch), memory)
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            for view, at, size, values in found:
                if shared is not None:
                    wanted = shared.value
                    place = np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)
                    hit = wanted[place] == values
                    at, size, values = at[hit], size[hit], values[hit]
                if not len(at):
                    continue
                of = row[at]
                columns = (
                    ids[of],
                    values.view(np.int64),
                    np.full(len(at), view),
                    at - first[of],
                    sizes[of],
                    [slots(view, i, n) if view else [] for i, n in zip(at.tolist(), size.tolist())],
                    [holes(view, i, n) if view else [] for i, n in zip(at.tolist(), size.tolist())],
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, kind) for x, kind in zip(columns, kinds)],
                    names=["id", "hash", "view", "pos", "n_tokens", "slots", "holes"],
                )

    return map_batches(rows, kernel, f"id long, {_WINDOWS}")


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``item_id``, ``n_matched``, ``n_item`` and ``verbatim`` of each document that holds an item's passage.

    ``n_matched`` counts the item's tokens in the best consistent match.  Null and empty
    texts, of documents or items, match nothing; a repeated row gives its result once.
    """
    items = benchmark.where("item_id is not null").select(F.col("item_id").alias("id"), "text").distinct()
    asked = stored(_windows(items), "benchmark_windows")
    rows = docs.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    found = None
    distinct = asked.select("hash").distinct()
    total = distinct.count()
    blocks = -(-total // BLOCK) or 1
    for k in range(blocks):
        part = distinct if blocks == 1 else distinct.where(F.pmod("hash", F.lit(blocks)) == k)
        only = np.sort(np.array([r.hash for r in part.toLocalIterator()], np.int64).view(np.uint64))
        if len(only):
            hits = _windows(rows, only)
            found = hits if found is None else found.union(hits)
    if found is None:
        return docs.sparkSession.createDataFrame([], f"`{key}` long, item_id long, n_matched int, n_item int, verbatim boolean")
    item = asked.select(
        "hash", "view", F.col("id").alias("item_id"), F.col("pos").alias("item_pos"), F.col("n_tokens").alias("n_item"),
        F.col("slots").alias("item_slots"), F.col("holes").alias("item_holes"),
    )
    if total <= SENT_WINDOWS:
        item = F.broadcast(item)
    met = found.drop("holes").distinct().join(item, ["hash", "view"])
    diagonal = met.groupBy("id", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift")).agg(
        F.first("n_item").alias("n_item"),
        F.array_sort(F.collect_set(F.when(F.col("view") == 0, F.col("item_pos")))).alias("plain"),
        F.array_sort(F.collect_set("item_pos")).alias("places"),
        F.size(F.array_distinct(F.flatten(F.collect_set("item_holes")))).alias("n_holes"),
        F.array_distinct(F.flatten(F.collect_set(F.arrays_zip("item_slots", "slots")))).alias("pairs"),
    )
    size = F.least(F.lit(WINDOW), F.col("n_item"))
    covered = lambda places: F.aggregate(
        places,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(size, p - s["last"])).alias("n")),
        lambda s: s["n"],
    )
    one_to_one = (F.size(F.array_distinct("pairs.item_slots")) == F.size("pairs")) & (
        F.size(F.array_distinct("pairs.slots")) == F.size("pairs")
    )
    # Word for word, or with placeholders that are consistent and leave enough words.
    worded = F.col("n_all") - F.col("n_holes") >= F.least(F.lit(LEAST_WORDS), "n_item")
    counts = diagonal.withColumn("n_plain", covered("plain")).withColumn("n_all", covered("places"))
    counts = counts.withColumn("n_matched", F.when(one_to_one & worded, F.col("n_all")).otherwise(F.col("n_plain")))
    least = F.least(F.lit(LEAST_TOKENS), "n_item")
    return (
        counts.where(F.col("n_matched") >= least)
        .groupBy(F.col("id").alias(key), "item_id")
        .agg(F.max("n_matched").alias("n_matched"), F.max("n_item").alias("n_item"), F.max(F.col("n_plain") >= least).alias("verbatim"))
    )


def remove(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents without a benchmark passage.

    Rows without a key stay; rows of one key go together.  All columns are kept, whatever their
    names.  An empty table gives no rows; an empty benchmark leaves all.
    """
    leaked = stored(matches(docs, benchmark, text, key).select(F.col(key).alias("leaked_key")).distinct(), "leaked")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{key}`").alias("row_key"))
    return rows.join(leaked, F.col("row_key") == F.col("leaked_key"), "left_anti").select("row.*")
