"""MinHash near-duplicates against all pairs of whole shingle sets."""

import random

import numpy as np
import pytest

from tidelog.llm import minhash, stars

SCHEMA = "doc_id long, text string, node string, key int, cell string"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "n", 1, "c") for k, t in rows], SCHEMA)


def shingles(text, size):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if len(words) < size:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size, percent=80):
    """(id, size of the set, component, kept) of every row."""
    sets = [shingles(t, size) for _, t in rows]
    top = list(range(len(rows)))

    def root(k):
        while top[k] != k:
            k = top[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                top[root(i)] = root(j)
    least = {}
    for k, (key, _) in enumerate(rows):
        if key is not None:
            least[root(k)] = min(key, least.get(root(k), key))
    out = []
    for k, (key, _) in enumerate(rows):
        component = least.get(root(k)) if sets[k] else key
        out.append((key, len(sets[k]), component, component is None or key == component))
    return sorted(out, key=str)


def got(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def edited(rnd, words, share):
    return [rnd.choice("uvwxyz") + str(rnd.randrange(99)) if rnd.random() < share else w for w in words]


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "abcdefgh" for b in ("an", "er", "ing", "o")]
    texts = []
    for _ in range(25):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice([2, 5, 12, 60, 150]))]
        texts.append(words)
        for _ in range(rnd.randrange(4)):
            words = edited(rnd, words, rnd.choice([0.0, 0.02, 0.05, 0.1]))
            texts.append(words)
    return [" ".join(w) for w in texts]


@pytest.mark.parametrize("size", [2, 5])
def test_components_equal_all_pairs(spark, size, monkeypatch):
    monkeypatch.setattr(minhash, "PIECE", 100)
    rows = list(enumerate(corpus(size)))
    rows += [(500, None), (501, ""), (502, " \n\t"), (503, "one"), (504, "ONE"), (505, "one two"), (506, "Zwölf Ünd"), (507, "zwölf Ünd")]
    rows += [(None, rows[3][1]), (None, "lone null key " * 3), (None, None), rows[9], rows[9], (9, "another text of the same key here")]
    rows += [(600, "long text " * 4000), (601, "long text " * 4000 + "end")]
    rnd = random.Random(1)
    rnd.shuffle(rows)
    assert got(minhash.near_duplicates(frame(spark, rows), words=size)) == brute(rows, size)


def test_many_edited_copies_of_one_original(spark, monkeypatch):
    """Copies near to the original, not to each other; small tiles; the original has a middle id."""
    monkeypatch.setattr(minhash, "TILE", 8)
    rnd = random.Random(4)
    original = [f"w{k}" for k in range(120)]
    texts = [" ".join(edited(rnd, original, 0.045)) for _ in range(60)]
    rows = [*enumerate(texts[:30]), (30, " ".join(original)), *enumerate(texts[30:], 31)]
    wanted = brute(rows, 2)
    assert got(minhash.near_duplicates(frame(spark, rows), words=2)) == wanted
    assert sum(r[2] == 0 for r in wanted) > 30


def test_chains_and_hubs_that_miss_members(spark, monkeypatch):
    """A text is like its neighbours in the chain alone, so links between members of open buckets decide."""
    monkeypatch.setattr(minhash, "TILE", 4)
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(words[3 * k : 3 * k + 60])) for k in range(60)]
    assert got(minhash.near_duplicates(frame(spark, rows), words=2)) == brute(rows, 2)
    assert {r[2] for r in brute(rows, 2)} == {0}


def test_open_buckets_are_compared_in_cells(spark):
    """All texts in one bucket, two groups of them, a hub that is like neither."""
    sets = {n: np.array(sorted(v), np.int64) for n, v in {b"h": range(200, 210), b"a": range(10), b"b": range(10), b"c": range(50, 60), b"d": range(50, 61)}.items()}
    nodes = spark.createDataFrame([(n, minhash._minima(v).astype(np.uint16).tobytes(), v.tolist()) for n, v in sets.items()], "node binary, minima binary, shingles array<long>")
    shared = spark.createDataFrame([(1, n, len(v)) for n, v in sets.items()], "key long, node binary, size long")
    hubs = spark.createDataFrame([(1, b"h")], "key long, hub binary")
    none = spark.createDataFrame([], "node binary, component binary")
    cells = minhash._open_cells(shared, hubs, none)
    links = {frozenset(map(bytes, r)) for r in minhash._cell_links(cells, nodes, 80).collect()}
    assert links == {frozenset((b"a", b"b")), frozenset((b"c", b"d"))}


def test_empty_table_and_low_similarity(spark):
    assert minhash.near_duplicates(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        minhash.near_duplicates(frame(spark, []), percent=50)


def test_minima_agree_as_often_as_sets_overlap():
    rnd = np.random.default_rng(2)
    pool = rnd.integers(-(2**63), 2**63 - 1, 4000)
    shares = []
    for k in range(40):
        a, b = np.unique(pool[k * 90 : k * 90 + 90]), np.unique(pool[k * 90 + 10 : k * 90 + 100])
        shares.append((minhash._minima(a) == minhash._minima(b)).mean())
    assert np.mean(shares) == pytest.approx(80 / 100, abs=0.02)


def test_star_components_with_hubs(spark, monkeypatch):
    monkeypatch.setattr(stars, "HUBS", 1)
    rnd = random.Random(6)
    links = [(0, k) for k in range(1, 2500)] + [(k, k + 1) for k in range(3000, 3040)] + [(5000, 5000), (7, 3000), (6001, 6000)]
    rnd.shuffle(links)
    found = dict(map(tuple, stars.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {k: 0 for k in [*range(2500), *range(3000, 3041)]} | {6000: 6000, 6001: 6000}
    assert stars.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rounds_on_few_links_are_few_tasks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        links = [(k, k + 1) for k in range(0, 400, 2)]
        found = stars.components(spark.createDataFrame(links, "a long, b long"))
        assert 0 < len(found.inputFiles()) <= stars.LEAST_TASKS
        assert dict(map(tuple, found.collect())) == {k: k - k % 2 for k in range(400)}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
