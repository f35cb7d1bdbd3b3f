"""Importance resampling and its radix sort against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidelog.llm import importance, radix

SCHEMA = "doc_id long, text string, rank string, place int, _digit string"


def brute(docs, target, buckets=importance.BUCKETS, run=1, percent=10, least=20, seed=2024):
    """Rows (id, features, weight, score, rank) as the rule is written."""

    def features(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return len(words), [" ".join(words[i : i + k]) for k in range(1, run + 1) for i in range(len(words) - k + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in features(t)[1])
    t = Counter(bucket(f) for x in target for f in features(x)[1])
    ns, nt = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (ns + buckets) / ((s[b] + 1) * (nt + buckets))))
    rows = []
    for key, text in docs:
        words, found = features(text)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(found), weight, score, None, words])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def texts(n, seed=3):
    rnd = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("an", "Ér", "9", "ing", "日本")]
    return [" ".join(rnd.choice(words) + rnd.choice(["", ".", ",", "\t"]) for _ in range(rnd.randrange(0, 60))) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "r", 1, "d") for k, t in rows], SCHEMA)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("run", [1, 3])
def test_resample_equals_brute_force(spark, monkeypatch, run):
    # Small pieces: texts are cut within runs of words.
    monkeypatch.setattr(importance, "PIECE", 40)
    docs = [*enumerate(texts(150)), (None, "b an " * 30), (7, "a9 " * 40), (7, "a9 " * 40), (900, None), (901, ""), (902, " .\n")]
    docs += [(1000, "aing " * 5000), (1001, "x" * 5000)]
    target = [*texts(12, seed=4), None, ""]
    found = importance.resample(frame(spark, docs), frame(spark, enumerate(target)), run=run, percent=30)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert got(found) == brute(docs, target, run=run, percent=30)


def test_ties_go_to_the_smaller_key_and_nulls_last(spark, monkeypatch):
    monkeypatch.setattr(importance, "noise", lambda key, seed=0: 5)
    docs = [(k, "an " * 25) for k in (9, -4, 3, None, 2**62, -(2**62))]
    found = {r["doc_id"]: r["rank"] for r in importance.resample(frame(spark, docs), frame(spark, []), percent=100).collect()}
    assert found == {-(2**62): 1, -4: 2, 3: 3, 9: 4, 2**62: 5, None: 6}


def test_empty_tables(spark):
    assert importance.resample(frame(spark, []), frame(spark, [(1, "a")])).count() == 0
    rows = importance.resample(frame(spark, [(1, "an " * 30)]), frame(spark, []), percent=100).collect()
    assert [r["rank"] for r in rows] == [1]


@pytest.mark.parametrize("chunk", [2, 16])
def test_radix_places_equal_a_sort(spark, monkeypatch, chunk):
    monkeypatch.setattr(radix, "CHUNK_BITS", chunk)
    monkeypatch.setattr(radix, "DIGIT_BITS", 3)
    rnd = random.Random(1)
    # A third of the rows share one key.
    rows = [(rnd.choice([5, rnd.randrange(-40, 900), None]), rnd.randrange(-(10**3), 10**3)) for _ in range(300)]
    df = spark.createDataFrame(rows, "a long, b long").repartition(5)
    placed = radix.ranked(df, [("a", True), ("b", False)]).collect()
    assert sorted(r["place"] for r in placed) == list(range(300))
    wanted = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [(r["a"], r["b"]) for r in sorted(placed, key=lambda r: r["place"])] == wanted


def test_radix_over_the_whole_range_of_longs(spark):
    values = [-(2**63), 2**63 - 1, 0, -1, 1, 2**40, -(2**40)]
    df = spark.createDataFrame([(v,) for v in values], "a long")
    for descends in (False, True):
        placed = radix.ranked(df, [("a", descends)]).orderBy("place").collect()
        assert [r["a"] for r in placed] == sorted(values, reverse=descends)
    assert radix.ranked(df.where(F.lit(False)), [("a", False)]).count() == 0
