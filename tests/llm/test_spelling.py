"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidelog.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int, cell string"


def brute_words(docs, every=97, points=5, least=3):
    count = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= points and n >= least}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n, len(near[w]), words[form[w]] if form[w] else -1) for w, n in words.items())


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], -1 if r["form_n"] is None else r["form_n"]) for r in df.collect())


def vocabulary(seed, letters, sizes, n, copies=3):
    """Random words and chains of edits of them, with repeated bigrams and words of one letter."""
    rnd, words = random.Random(seed), set()
    for _ in range(n):
        w = "".join(rnd.choice(letters) for _ in range(rnd.choice(sizes)))
        words.add(w)
        for _ in range(copies):
            at, kind = rnd.randrange(len(w) + 1), rnd.randrange(3)
            w = w[:at] + (rnd.choice(letters) if kind < 2 else "") + w[at + (kind > 0) :]
            words.add(w)
    return {w: rnd.choice([3, 4, 6, 12, 50]) for w in words if len(w) >= 5}


@pytest.mark.parametrize(
    ("letters", "sizes", "n"),
    [("ab", (5, 6, 7), 200), ("abé", (5, 8, 12), 150), ("etaoinÿß", (5, 6, 9), 150), ("abcd", (58, 59, 60, 61, 62, 130), 60)],
)
def test_variants_equal_brute_force(spark, letters, sizes, n):
    words = vocabulary(7, letters, sizes, n)
    words |= {"a" * k: 3 * k for k in range(5, 12)} | {"a" * k: 3 for k in range(57, 64)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert got(spelling.variants(df)) == brute(words)


def test_tiles_of_a_large_cell_all_meet(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TILE", 4)
    monkeypatch.setattr(spelling, "HELD", 5)
    words = vocabulary(2, "ab", (5, 6), 100)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert got(spelling.variants(df)) == brute(words)


def test_texts_to_variants(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 50)
    monkeypatch.setattr(spelling, "COUNTED", 100)
    rnd = random.Random(4)
    base = ["Wörter", "colour", "color", "ANALYSE", "analyze", "façade", "naïve×", "straße", "seperate", "separate", "日本color"]
    docs = [(k, " ".join(rnd.choice(base) + rnd.choice(["", ",", "1", "\n"]) for _ in range(80))) for k in range(120)]
    docs += [(None, "colour " * 9), (5, None), (6, ""), (7, " \n1"), docs[3], docs[3], (8, "a" * 7000 + " colour " * 700)]
    df = spark.createDataFrame([(k, t, "w", 1, "c") for k, t in docs], SCHEMA)
    words = brute_words(docs)
    assert got(spelling.group_variants(df)) == brute(words)
    assert any(r[1] for r in brute(words))


def test_empty_table_and_no_words(spark):
    assert spelling.group_variants(spark.createDataFrame([], SCHEMA)).count() == 0
    blank = spark.createDataFrame([(1, "a b", "w", 1, "c"), (2, None, "w", 1, "c")], SCHEMA)
    assert spelling.group_variants(blank).count() == 0


def test_pivots_are_disjoint_and_rarest():
    weight = [5, 1, 9, 2]
    # Places 0, 1, 2, 5: the rarest pair (1 and 3) does not overlap; without the last, 0 and 2 is the only one.
    assert spelling.pivots([(0, 0), (1, 1), (2, 2), (3, 5)], weight) == ((1, 1), (3, 5))
    assert spelling.pivots([(0, 0), (1, 1), (2, 2)], weight) == ((0, 0), (2, 2))


def test_one_edit_of_rows():
    rnd = random.Random(3)
    for _ in range(400):
        a = "".join(rnd.choice("ab") for _ in range(6))
        b = "".join(rnd.choice("ab") for _ in range(rnd.choice([6, 7])))
        rows = [np.frombuffer(x.encode(), np.uint8)[None, :] for x in (a, b)]
        assert bool(spelling._one_edit(*rows)[0]) == one_edit(a, b)
