"""The text operators against brute force on small tables, odd rows included."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidelog.llm import byte_bpe, decontaminate, licenses, lm_score, pu_classifier, quality_rules, repeats, simhash, warc

WORDS = [f"{a}{b}" for a in ("ver", "lin", "mo", "tak", "sur", "pel", "dra", "on") for b in ("a", "en", "is", "or", "und")]


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) + ("." if rnd.random() < 0.1 else "") for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Texts with copies, near copies, a shared passage, nulls, empty and long ones, repeated rows."""
    rnd = random.Random(5)
    texts = [prose(rnd, rnd.randrange(30, 200)) for _ in range(60)]
    passage = prose(rnd, 80)
    texts[3] = texts[2]
    for k in (10, 11, 12):
        texts[k] += " " + passage + " " + prose(rnd, 20)
    words = texts[20].split(" ")
    words[5] = "changed"
    texts[21] = " ".join(words)
    texts += ["", None, "   \n\t ", "one", "x" * 3000, "ab" * 700, texts[20], "# $ % | " * 80, "The End\n" * 70]
    rows = [(k, t, "en", f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    return [*rows, rows[7], rows[7]]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark, corpus):
    # An extra column that has the name of an internal one.
    return spark.createDataFrame(corpus, SCHEMA).withColumn("row", F.lit("extra")).withColumn("ranges", F.lit(1))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(rows):
    out = {}
    for r in rows:
        out.setdefault(r["doc_id"], []).append(r)
    return out


# -- repeats ---------------------------------------------------------------------


def test_repeated_passages_equal_brute_force(docs, corpus, empty):
    raws = [(i, (t or "").encode()) for i, t, *_ in corpus]
    seen = Counter(r[k : k + 200] for _, r in raws for k in range(len(r) - 199))
    got = by_id(repeats.remove(docs).collect())
    assert sum(map(len, got.values())) == len(corpus)
    for i, raw in raws:
        under = bytearray(len(raw))
        for k in range(len(raw) - 199):
            if seen[raw[k : k + 200]] > 1:
                under[k : k + 200] = b"\1" * 200
        kept = bytes(b for b, u in zip(raw, under) if not u)
        for row in got[i]:
            assert bytes(row.kept) == kept and row.n_bytes == len(raw)
            assert sum(s.end - s.start for s in row.spans) == len(raw) - len(kept)
    assert repeats.remove(empty).count() == 0


def test_a_phrase_frequent_in_a_batch_is_found_in_all_contexts(spark):
    rnd = random.Random(9)
    passage = prose(rnd, 60)
    rows = [(k, prose(rnd, 40) + " " + passage + " " + prose(rnd, 40)) for k in range(60)]
    got = repeats.remove(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    for row in got:
        assert passage.encode() not in bytes(row.kept)
        assert len(passage) <= sum(s.end - s.start for s in row.spans) <= len(passage) + 80


# -- simhash ---------------------------------------------------------------------


def fingerprint(text, size):
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))]
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(n, links):
    label = list(range(n))
    for _ in range(n):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_simhash_components_equal_brute_force(docs, corpus, empty):
    marks = [fingerprint(t, 3) for _, t, *_ in corpus]
    n = len(corpus)
    links = [(a, b) for a in range(n) for b in range(a) if bin(marks[a] ^ marks[b]).count("1") <= 3]
    label = components(n, links)
    got = by_id(simhash.near_duplicates(docs).collect())
    assert sum(map(len, got.values())) == n
    for k, (i, *_) in enumerate(corpus):
        for row in got[i]:
            assert row.fingerprint % (1 << 64) == marks[k]
            assert row.component_id == min(corpus[j][0] for j in range(n) if label[j] == label[k])
    assert simhash.near_duplicates(empty).count() == 0


def test_large_buckets_are_cut_into_tiles(spark, monkeypatch):
    rnd = random.Random(1)
    center = rnd.getrandbits(63)
    values = {center ^ sum(1 << b for b in rnd.sample(range(62), rnd.randrange(7))) for _ in range(300)}
    values |= {rnd.getrandbits(63) for _ in range(200)}
    values = sorted(values)
    monkeypatch.setattr(simhash, "TILE", 16)
    nodes = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "node long, fingerprint long")
    found = {r.node: r.component for r in simhash.components(simhash.fingerprint_links(nodes)).collect()}
    links = [(a, b) for a in range(len(values)) for b in range(a) if bin(values[a] ^ values[b]).count("1") <= 3]
    label = components(len(values), links)
    assert [found.get(k, k) for k in range(len(values))] == label


def test_chains_of_links_are_one_component(spark):
    order = list(range(200))
    random.Random(2).shuffle(order)
    links = spark.createDataFrame(list(zip(order, order[1:])), "a long, b long")
    assert {r.component for r in simhash.components(links).collect()} == {0}
    assert simhash.components(links.limit(0)).count() == 0


def test_one_of_each_group_of_near_copies_stays(docs, corpus, empty):
    marks = [fingerprint(t, 3) for _, t, *_ in corpus]
    n = len(corpus)
    label = components(n, [(a, b) for a in range(n) for b in range(a) if bin(marks[a] ^ marks[b]).count("1") <= 3])
    wanted = sorted({min(corpus[j][0] for j in range(n) if label[j] == label[k]) for k in range(n)})
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == wanted
    assert simhash.keep_one(empty).count() == 0


def test_kept_rows_keep_clashing_columns_and_their_own_texts(spark):
    rnd = random.Random(3)
    texts = [prose(rnd, 60) for _ in range(4)]
    # Key 5 has two different texts, key 7 a copy of one of them; key 8 comes twice.
    rows = [(5, texts[0], 1), (5, texts[1], 2), (7, texts[1], 3), (8, texts[2], 4), (8, texts[2], 4), (None, texts[0], 5), (None, None, 6), (9, texts[2] + "x", 7)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, row int")
    for name in ("id", "digest", "nth", "_spare", "_nth", "_leaked", "fingerprint", "group", "component", "node"):
        frame = frame.withColumn(name, F.col("row"))
    found = simhash.keep_one(frame)
    assert found.columns == frame.columns
    assert sorted(r.row for r in found.collect() if r.row != 7) == [1, 2, 4, 5, 6]
    assert all(r["_nth"] == r["group"] == r["digest"] == r["row"] for r in found.collect())
    marked = spark.createDataFrame([(k, " ".join(f"w{i}" for i in range(40 * k, 40 * k + 40))) for k in range(3)], "item_id long, text string")
    leaking = frame.withColumn("leaked_key", F.lit(1)).withColumn("row_key", F.lit(2))
    assert decontaminate.remove(leaking, marked).count() == len(rows)
    assert decontaminate.remove(leaking, marked).columns == leaking.columns


# -- decontamination -------------------------------------------------------------


def test_passages_are_found_verbatim_and_with_other_values(spark, docs):
    item = "A train leaves the old station with 40 people and after 3 hours it has gone 210 km to the north side of town"
    other = "A train leaves the old station with 55 people and after 7 hours it has gone 930 km to the north side of town"
    mixed = "A train leaves the old station with 40 people and after 40 hours it has gone 3 km to the north side of town"
    benchmark = spark.createDataFrame([(1, item), (2, None), (3, ""), (1, item), (None, item)], "item_id long, text string")
    rows = [
        (900, "Well. " + item.upper() + " Good.", "en", "s", 0),
        (901, "So: " + other + ", they say.", "en", "s", 0),
        (902, " ".join(item.split()[:9]), "en", "s", 0),
        (903, "Inconsistent: " + mixed.replace("north", "40 north"), "en", "s", 0),
        (None, item, "en", "s", 0),
    ]
    more = spark.createDataFrame(rows, SCHEMA).unionByName(docs.select("doc_id", "text", "lang", "source", "n_chars"))
    got = {r.doc_id: r for r in decontaminate.matches(more, benchmark).collect()}
    assert set(got) == {900, 901}
    assert got[900].verbatim and got[900].n_matched == got[900].n_item == 24
    assert not got[901].verbatim and got[901].item_id == 1
    left = {r.doc_id for r in decontaminate.remove(more, benchmark).collect()}
    assert not left & {900, 901} and {902, 903, None} <= left
    assert decontaminate.matches(more, benchmark.limit(0)).count() == 0


def test_slots_must_map_one_to_one(spark):
    item = "put 12 pens by 30 cups then lay 12 cards on 30 mats and take 12 seats at 30 desks"
    good = item.replace("12", "5").replace("30", "6")
    bad = item.replace("12", "5").replace("30", "5")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = spark.createDataFrame([(1, good), (2, bad)], "doc_id long, text string")
    assert [r.doc_id for r in decontaminate.matches(rows, benchmark).collect()] == [1]


def test_one_changed_value_at_any_place_is_found(spark):
    rnd = random.Random(6)
    items, rows = [], []
    for n in range(8, 25):
        for place in range(n):
            words = [f"{rnd.choice(WORDS)}{''.join(rnd.choice('bcdfg') for _ in range(4))}" for _ in range(n)]
            k = len(items)
            items.append((k, " ".join([*words[:place], "41", *words[place + 1 :]])))
            rows.append((k, "alpha beta " + " ".join([*words[:place], "97", *words[place + 1 :]]) + " gamma delta"))
    dense = "red 3 blue 4 7 green 5 9 pink 6 gray 11 8 teal 12 plum 13"
    items.append((1000, dense))
    numbers = "21 22 23 24 25 26 27 28 29 30 31 32 33 34"
    items.append((1001, numbers))
    rows.append((1000, "so " + " ".join(str(int(x) + 50) if x.isdigit() else x for x in dense.split()) + " it is"))
    rows.append((1001, "so " + " ".join(str(int(x) + 50) for x in numbers.split()) + " it is"))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.matches(spark.createDataFrame(rows, "doc_id long, text string"), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(k, k) for k, _ in rows if k != 1001}
    assert not any(r.verbatim for r in found if r.n_item <= 13)
    assert all(r.n_matched == r.n_item for r in found)


FRAMES = [
    # name, number, unit and the words around them; each part is changed in turn.
    ("{name} sold clips to {n} of her friends in April and then she sold half as many clips in May", ["Natalia", "Marissa"], ["48", "52", "seven"], None),
    ("{name} has {n} red apples and buys {m} more at the market before going home with {name} again", ["Alice", "Bob"], ["3", "five"], ["5", "nine"]),
    ("In the town {name} walks {n} miles each day and rests for {m} hours under the old oak tree", ["Tom", "Emma"], ["12", "four"], ["2", "six"]),
    ("{n} Freunde kaufen {m} Karten für das Konzert und teilen sich danach die Kosten ganz gerecht auf", None, ["Drei", "Fünf"], ["zwei", "sieben"]),
    ("{name} achète {n} pommes et {m} poires au marché puis rentre à la maison avec son panier plein", ["Marie", "Lucie"], ["deux", "huit"], ["quatre", "trente"]),
    ("{name} compra {n} libros y {m} cuadernos en la tienda y luego vuelve a casa con su hermana", ["Carlos", "Diego"], ["cuatro", "quince"], ["dos", "20"]),
]


def test_other_names_and_numbers_in_four_languages(spark):
    items, rows, wanted = [], [], set()
    for k, (frame, names, ns, ms) in enumerate(FRAMES):
        fill = lambda i, j, m, frame=frame, names=names, ns=ns, ms=ms: frame.format(
            name=names[i] if names else "", n=ns[j], m=ms[m] if ms else ""
        )
        items.append((k, fill(0, 0, 0)))
        for i in range(2 if names else 1):
            for j in range(len(ns)):
                for m in range(2 if ms else 1):
                    for before in ("", "He read it aloud. ", "and so "):
                        rows.append((len(rows), before + fill(i, j, m) + " so they say"))
                        wanted.add((rows[-1][0], k))
    # Other words in place of the names and numbers are other texts.
    for k, (frame, *_) in enumerate(FRAMES):
        words = frame.split()
        rows.append((len(rows), " ".join(w if at % 4 else f"other{at}" for at, w in enumerate(words))))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.matches(spark.createDataFrame(rows, "doc_id long, text string"), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == wanted


def test_one_changed_name_at_any_place_is_found(spark):
    rnd = random.Random(9)
    items, rows = [], []
    for n in (9, 13, 20):
        for place in range(n):
            words = [f"{rnd.choice(WORDS)}{''.join(rnd.choice('bcdfg') for _ in range(4))}" for _ in range(n)]
            k = len(items)
            items.append((k, " ".join([*words[:place], "Natalia", *words[place + 1 :]])))
            rows.append((k, "Alpha beta. " + " ".join([*words[:place], "Marissa", *words[place + 1 :]]) + " gamma delta"))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.matches(spark.createDataFrame(rows, "doc_id long, text string"), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(k, k) for k, _ in rows}


# -- quality ---------------------------------------------------------------------


def test_rules_ledger(docs, corpus, empty):
    got = by_id(quality_rules.apply_policy(quality_rules.ledger(docs), quality_rules.PROSE).collect())
    for i, text, *_ in corpus:
        words = [w for w in (text or "").replace("\n", " ").replace("\t", " ").split(" ") if w]
        windows = Counter(zip(words, words[1:], words[2:]))
        marked = {k + d for k, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for d in range(3)}
        lines = [x for x in (text or "").split("\n") if x.strip(" \t")]
        for row in got[i]:
            assert (row.n_words, row.word_chars, row.n_repeat_words) == (len(words), sum(map(len, words)), len(marked))
            assert row.n_dup_lines == len(lines) - len(set(lines))
            assert row.n_symbols == sum(c in "#*$%&|<>" for c in text or "")
            if row.kept:
                assert row.n_words >= 50 and row.n_repeat_words * 2 <= row.n_words
    assert not got[67][0].kept and not got[68][0].kept and got[0][0].kept
    assert {r.doc_id for r in quality_rules.keep_good(docs).collect()} == {i for i, r in got.items() if r[0].kept}
    assert quality_rules.keep_good(docs).columns == docs.columns
    assert quality_rules.ledger(empty).count() == 0


def test_ablations_add_up(docs, empty):
    rows = quality_rules.ledger(docs)
    table = {(r.policy, r.rule): r for r in quality_rules.ablations(rows).collect()}
    masks = [r.failures for r in rows.collect()]
    for (_, rule), row in table.items():
        assert row.failed == sum(m & quality_rules.RULES[rule] != 0 for m in masks)
    few = table["prose", "few_words"]
    assert few.rejected == sum(m != 0 for m in masks) and few.only_this == sum(m == 1 for m in masks)
    assert {r.failed for r in quality_rules.ablations(quality_rules.ledger(empty)).collect()} == {0}


# -- byte-level BPE --------------------------------------------------------------


@pytest.fixture(scope="module")
def ranks():
    import public_tokenizers

    return byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


def test_ids_are_those_of_the_library_and_decode_to_the_text(docs, corpus, ranks, empty):
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=ranks[1], mergeable_ranks=ranks[0], special_tokens={})
    got = by_id(byte_bpe.encode(docs, *ranks).collect())
    for i, text, *_ in corpus:
        for row in got[i]:
            assert row.token_ids == library.encode_ordinary(text or "")
            assert bytes(row.decoded).decode() == (text or "")
    assert byte_bpe.digests(empty, *ranks).count() == 0
    kept = byte_bpe.with_ids(docs, *ranks)
    assert kept.columns == [*docs.columns, "token_ids", "n_tokens"] and kept.count() == len(corpus)


@pytest.mark.parametrize("seed", range(5))
def test_any_text_is_encoded_as_the_library_does(ranks, seed):
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=ranks[1], mergeable_ranks=ranks[0], special_tokens={})
    rnd = random.Random(seed)
    alphabet = "aAbz01 \n\t.,'’éß中😀\x1c\x85 \xa0" + "thern ing"
    bodies = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(80))) for _ in range(300)]
    bodies += ["a" * 4000, "ab" * 900, "  \n \n x", "é" * 500]
    encoder = byte_bpe.Encoder(*ranks)
    for body, ids in zip(bodies, encoder.batch(bodies)):
        assert ids.tolist() == library.encode_ordinary(body)


def test_forgetting_words_between_batches_changes_nothing(ranks, monkeypatch):
    bodies = [["The old words", "The new"], ["The old words", "once more The"], ["The end"]]
    whole = [[x.tolist() for x in byte_bpe.Encoder(*ranks).batch(b)] for b in bodies]
    monkeypatch.setattr(byte_bpe, "REMEMBERED_WORDS", 2)
    encoder = byte_bpe.Encoder(*ranks)
    assert [[x.tolist() for x in encoder.batch(b)] for b in bodies] == whole


def test_the_native_fold_gives_the_same_ids(spark, ranks):
    words = [" the", "thernonsh", " Straße", "é", "a", " 2024", "aaaaaaaa"]
    found = byte_bpe.fold_words(spark.createDataFrame([(w,) for w in words], "word string"), ranks[0])
    assert {r.word: r.token_ids for r in found.collect()} == {w: byte_bpe.fold(w.encode(), ranks[0]) for w in words}


# -- licences --------------------------------------------------------------------


def test_licences_are_found_and_inherited(spark):
    files = [
        ("a/LICENSE", "Licensed under the Apache License, Version 2.0."),
        ("a/x.txt", "Plain words."),
        ("a/b/y.txt", None),
        ("a/b/z.txt", "Some words of a text that goes on and on for a while\nReleased under the MIT License."),
        ("c/w.txt", ""),
        ("ab/v.txt", "Nothing here."),
        (None, "All rights reserved."),
        ("a/x.txt", "Plain words."),
    ]
    found = licenses.scan(spark.createDataFrame(files, "path string, text string").withColumn("licence", F.lit("clash"))).collect()
    got = {r.path: (r.licence, r.origin, r.inherited_from) for r in found}
    assert len(found) == len(files)
    assert got["a/LICENSE"] == ("Apache-2.0", "file", None)
    assert got["a/x.txt"] == got["a/b/y.txt"] == ("Apache-2.0", "inherited", "a")
    assert got["a/b/z.txt"] == ("MIT", "header", None)
    assert got["c/w.txt"] == got["ab/v.txt"] == got[None] == (None, "none", None)


# -- WARC ------------------------------------------------------------------------


def test_archives_round_trip(spark, tmp_path):
    body = "<p>x</p>\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" + "é" * 50
    pages = [
        (5, "https://B.example.com/x", body),
        (3, "https://a.example.com/y?z=1", body),
        (9, None, body),
        (1, "http://a.example.com/", None),
        (2, "odd url\nwith lines", ""),
        (None, "http://c.example.org/", body),
        (5, "https://B.example.com/x", body),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("first", F.lit(0))
    rows = warc.round_trip(frame, str(tmp_path / "w")).orderBy("range", "place").collect()
    got = {r.page_id: r for r in rows}
    assert len(rows) == len(pages)
    keys = [(r.url_key, r.captured, -1 if r.page_id is None else r.page_id) for r in rows]
    assert keys == sorted(keys)
    assert got[3].record_type == "response" and got[3].refers_to is None
    assert {got[i].refers_to for i in (5, 9, None)} == {3}
    assert got[2].refers_to == 1 and got[1].payload_bytes == 0
    assert got[9].payload_bytes == len(body.encode())
    assert warc.round_trip(frame.limit(0), str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_loser_tree_merges(seed):
    rnd = random.Random(seed)
    runs = [sorted((rnd.randrange(20), k) for _ in range(rnd.randrange(9))) for k in range(rnd.randrange(9))]
    assert list(warc.LoserTree(runs, order=lambda x: x)) == sorted(x for run in runs for x in run)


# -- models ----------------------------------------------------------------------


def test_language_model_counts_and_base(docs, corpus, ranks, empty):
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    tokens = lambda t: [*(t or "").encode().lower().split(), b"\n"]
    counts = Counter(w for i, t, *_ in corpus if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    got = by_id(lm_score.score(docs, *ranks).collect())
    for i, text, *_ in corpus:
        base = sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(text))
        for row in got[i]:
            assert row.held_out == held(i) and row.train_tokens == n
            assert row.n_tokens == len(tokens(text)) and row.n_known == sum(counts[w] > 0 for w in tokens(text))
            assert row.base_score == pytest.approx(base)
            assert row.score < 0
    assert lm_score.score(empty, *ranks).count() == 0


def test_rare_words_meet_their_counts(docs, ranks, monkeypatch):
    whole = {(r.doc_id, r.n_known, round(r.base_score, 6)) for r in lm_score.score(docs, *ranks).collect()}
    monkeypatch.setattr(lm_score, "DICTIONARY", 30)
    assert {(r.doc_id, r.n_known, round(r.base_score, 6)) for r in lm_score.score(docs, *ranks).collect()} == whole


def test_rare_pairs_meet_their_counts(docs, ranks, monkeypatch):
    whole = sorted((r.doc_id, round(r.score, 3)) for r in lm_score.score(docs, *ranks).collect())
    monkeypatch.setattr(lm_score, "PAIRS", 20)
    assert sorted((r.doc_id, round(r.score, 3)) for r in lm_score.score(docs, *ranks).collect()) == whole


def test_scores_do_not_depend_on_partitions(docs, ranks, monkeypatch):
    monkeypatch.setattr(lm_score, "SHARD_WORDS", 900)
    monkeypatch.setattr(lm_score, "STEP_WINDOWS", 64)
    one = sorted((r.doc_id, r.score) for r in lm_score.score(docs.coalesce(1), *ranks).collect())
    many = sorted((r.doc_id, r.score) for r in lm_score.score(docs.repartition(8, "text"), *ranks).collect())
    assert [k for k, _ in one] == [k for k, _ in many]
    assert [x for _, x in one] == pytest.approx([x for _, x in many], rel=1e-5)


def test_attention_learns_from_every_window(spark, ranks, monkeypatch):
    """Each piece of each training text is a target once, and an end follows only the text's last word."""
    rnd = random.Random(11)
    bodies = [prose(rnd, n) for n in (3, 40, 200, 900)] + [""]
    seen = []
    monkeypatch.setattr(lm_score.Steps, "_step", lambda self, context, target: seen.append((context, target)))
    monkeypatch.setattr(lm_score, "STEP_WINDOWS", 50)
    # The kernel runs here, so that what it trains on can be seen.
    def here(rows, kernel, schema):
        list(kernel(rows.toArrow().to_batches(max_chunksize=2)))
        return spark.createDataFrame([], schema)

    monkeypatch.setattr(lm_score, "map_batches", here)
    rows = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string")
    pieces = lm_score.Pieces(*ranks)
    model = lm_score.new_model(np.ones(pieces.size), (np.array([5]), np.array([3])))
    model = model.with_parameters(model.parameters())
    model.cls[:], model.cls[0] = 0, 1  # the end has a class of its own
    lm_score._train(rows, 1, model, *ranks)
    numbers, words = pieces.numbers([b.encode().lower().split() for b in bodies])
    targets = np.concatenate([t.ravel() for _, t in seen])
    assert (targets >= 0).sum() == pieces.sizes(numbers, words).sum() == len(pieces.places(numbers))
    assert (targets == 1).sum() == len(bodies)
    assert {len(t) for _, t in seen[:-1]} == {50}


def test_stored_pieces_are_the_words(spark, ranks):
    """Texts are cut once: the ids alone give every word and its pairs, those with odd blanks included."""
    rnd = random.Random(12)
    bodies = [prose(rnd, 300), None, "", "It's 12345 \u00a0x \u2003 a\x1cb caf\u00e9\u00e9 \u4e2d\u6587 don't ... it's \n\n IT'S", "a" * 5000, " \t "]
    rows = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string").withColumn("held_out", F.lit(False))
    stored = {r.doc_id: r.pieces for r in lm_score.corpus_pieces(rows, *ranks).collect()}
    cutter, opening = lm_score.Pieces(*ranks), lm_score._opening(ranks[0])
    ids = np.concatenate([np.frombuffer(stored[k], lm_score._kind(len(opening))) for k in range(len(bodies))]).astype(np.int32)
    tokens = [w for b in bodies for w in [*(b or "").encode().lower().split(), b"\n"]]
    words = lm_score.Words(ids, opening)
    assert len(words.number) == len(tokens) and len(words.hash) == len(set(tokens))
    assert len(set(zip(tokens, words.number.tolist()))) == len(words.hash)
    assert Counter(words.number.tolist()) == dict(enumerate(words.times.tolist()))
    assert (words.ids[words.place] == ids).all()
    one_by_one = [i + 1 for w in tokens for i in (cutter.cut(" " + w.decode()) if w != b"\n" else [-1])]
    assert ids.tolist() == one_by_one
    pairs = Counter((p, i) for p, i in zip([0, *one_by_one], one_by_one) if not opening[i]) + Counter((0, i) for i in one_by_one if opening[i])
    got = Counter()
    for p, i, n in zip(words.before.tolist(), words.ids.tolist(), np.repeat(words.times, words.size).tolist()):
        got[p, i] += n
    assert got == pairs


def test_long_texts_come_in_bounded_parts(monkeypatch):
    monkeypatch.setattr(lm_score, "PART", 50)
    each = [b"a" * n for n in (10, 40, 2, 300, 50, 48, 2, 2)]
    batch = pa.RecordBatch.from_arrays([pa.array(each, pa.binary())], names=["pieces"])
    parts = [x.column("pieces").to_pylist() for x in lm_score._parts(batch)]
    assert [[len(x) for x in part] for part in parts] == [[10, 40], [2], [300], [50], [48, 2], [2]]
    assert list(lm_score._parts(batch.slice(0, 0))) == []


def test_work_by_place_is_as_wide_as_the_classes():
    """So that the model's width costs no place anything; contexts hold half a window at least."""
    model = lm_score.new_model(np.ones(3000), (np.array([5]), np.array([3])))
    assert lm_score.WIDTH >= 4 * lm_score.CLASSES and lm_score.WINDOW >= 16
    _, kept = lm_score._forward(model, np.zeros((2, lm_score.WINDOW), np.int32))
    assert all(x.shape[-1] in (lm_score.WINDOW, lm_score.CLASSES) for x in kept)


def test_attention_scores_equal_a_slow_loop():
    """Place by place, key by key, without tables, windows or batches."""
    rnd = np.random.default_rng(5)
    model = lm_score.new_model(rnd.integers(1, 50, 700).astype(float), (np.array([5]), np.array([3])))
    model = model.with_parameters([(p + 0.2 * rnd.standard_normal(p.shape)).astype(np.float64) for p in model.parameters()])
    size = np.array([1, 7, 8, 9, 40, 16])
    ids = rnd.integers(0, 700, size.sum()).astype(np.int32)
    got, half = lm_score.attention_scores(lm_score.Tables(model), ids, size), lm_score.WINDOW // 2
    first = 0
    for n in size:
        row, cls = model.row[ids[first : first + n]], model.cls[ids[first : first + n]]
        for t in range(n):
            begin = max(0, t // half * half - half)
            hidden = np.zeros(lm_score.WIDTH)
            if t > 0:
                q = model.embed[row[t - 1]] @ model.query
                score = [q @ (model.embed[row[j]] @ model.key) / np.sqrt(lm_score.WIDTH) + model.place[t - 1 - j] for j in range(begin, t)]
                weight = np.exp(score) / np.exp(score).sum()
                hidden = sum(w * (model.embed[row[j]] @ model.value) for w, j in zip(weight, range(begin, t))) + model.embed[row[t - 1]]
            logits = hidden @ model.out + model.bias
            assert got[first + t] == pytest.approx(logits[cls[t]] - np.log(np.exp(logits).sum()), rel=1e-6)
        first += n


def test_attention_gradients_are_those_of_the_loss():
    rnd = np.random.default_rng(0)
    model = lm_score.new_model(rnd.integers(1, 50, 3000).astype(float), (np.array([5, 1 << 32 | 7]), np.array([3, 4])))
    model = model.with_parameters([(p + 0.1 * rnd.standard_normal(p.shape)).astype(np.float64) for p in model.parameters()])
    context = rnd.integers(-1, lm_score.EMBEDDED, (4, lm_score.WINDOW))
    context[:, lm_score.WINDOW // 2 :] = np.abs(context[:, lm_score.WINDOW // 2 :])
    target = rnd.integers(-1, lm_score.CLASSES, (4, lm_score.WINDOW // 2))

    def loss(m):
        logits, _ = lm_score._forward(m, context)
        log = lm_score._log_softmax(logits)
        picked = np.take_along_axis(log, np.maximum(target, 0)[..., None], -1)[..., 0]
        return -picked[target >= 0].mean()

    for k, g in enumerate(lm_score.gradients(model, context, target)):
        flat = np.argsort(-np.abs(g).ravel())[:3]
        for at in flat:
            up, down = ([p.copy() for p in model.parameters()] for _ in range(2))
            up[k].ravel()[at] += 1e-4
            down[k].ravel()[at] -= 1e-4
            slope = (loss(model.with_parameters(up)) - loss(model.with_parameters(down))) / 2e-4
            assert g.ravel()[at] == pytest.approx(slope, rel=0.02, abs=1e-4)


def test_every_piece_is_scored_once_and_sums_to_one():
    counts = np.random.default_rng(1).integers(1, 9, 40).astype(float)
    model = lm_score.new_model(counts, (np.array([3 << 32 | 4, 5]), np.array([6, 2])))
    history = [7, 3]
    total = 0.0
    for last in range(40):
        ids = np.array([*history, last], np.int32)
        before = np.array([0, 7, 3], np.int32)
        scores = model.in_class(ids, before)[0] + lm_score.attention_scores(lm_score.Tables(model), ids, np.array([3]))
        total += np.exp(scores[-1])
    assert total == pytest.approx(1.0, abs=1e-4)


def test_quality_scores_separate_held_out_rows(spark):
    rnd = random.Random(3)
    rows, marks = [], []
    for k in range(400):
        good = rnd.random() < 0.8
        text = prose(rnd, 120) if good else " ".join(w + "$$" for w in prose(rnd, 120).split())
        rows.append((k, text))
        if k % 2:
            marks.append((k, int(good)))
    rows += [(1000, None), (1001, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("quality", F.lit(0))
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    found = {r.doc_id: r for r in pu_classifier.score(frame, pu_classifier.fit(frame, labels)).collect()}
    assert len(found) == len(rows) and found[1000].score == found[1001].score
    held = [k for k, r in found.items() if r.held_out and k < 400]
    assert sum((found[k].predicted == 1) == ("$" not in rows[k][1]) for k in held) >= 0.95 * len(held)
    none = pu_classifier.fit(frame, labels.limit(0))
    assert all(r.score == pytest.approx(0.5) for r in pu_classifier.score(frame.limit(5), none).collect())
    assert pu_classifier.score(frame.limit(0), pu_classifier.fit(frame.limit(0), labels)).count() == 0
    # Rows of one id multiply, the sample does not; a very long text is one row.
    many = frame.where("doc_id < 400").unionByName(spark.createDataFrame([(1, "good words " * 20_000, 0)] * 3, frame.schema))
    assert pu_classifier.score(many, pu_classifier.fit(many, labels)).count() == 403


@pytest.mark.parametrize("prior", [0.25, 0.5, 0.8])
def test_the_class_prior_is_estimated_from_unlabelled_text(prior):
    rnd = random.Random(17)

    def text(good):
        words = prose(rnd, rnd.randrange(60, 150)).split()
        if not good:
            words = [w + rnd.choice(["", "$$", "||", "!!"]) for w in words]
        return " ".join(words)

    feature = lambda n, good: np.array([pu_classifier.features(text(good)) for _ in range(n)])
    unlabelled = np.vstack([feature(int(1200 * prior), True), feature(1200 - int(1200 * prior), False)])
    np.random.default_rng(1).shuffle(unlabelled)
    assert pu_classifier.estimated_prior(feature(600, True), unlabelled) == pytest.approx(prior, abs=0.05)


# -- pipeline --------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path, corpus, ranks):
    import corpus_pipeline

    spark.createDataFrame(corpus, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    passage = " ".join((corpus[30][1] or "").split()[:25])
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r.doc_id for r in rows}
    good = sorted({(r.doc_id, r.text) for r in quality_rules.keep_good(spark.createDataFrame(corpus, SCHEMA)).collect()})
    marks = [fingerprint(t, 3) for _, t in good]
    n = len(good)
    label = components(n, [(a, b) for a in range(n) for b in range(a) if bin(marks[a] ^ marks[b]).count("1") <= 3])
    assert ids == {good[k][0] for k in range(n) if label[k] == k} - {30}
    assert 3 not in ids and {0, 2, 20} <= ids
    assert len(rows) == len(ids)
    for r in rows:
        assert hashlib.sha256(r.text.encode()).digest() and r.n_tokens == len(r.token_ids) > 0


def test_pipeline_keeps_other_columns_and_passes_empty_tables(spark, tmp_path, corpus, ranks):
    import corpus_pipeline

    clash = spark.createDataFrame(corpus[:20], SCHEMA)
    for name in ("_leaked", "_spare", "_nth", "nth", "digest", "id", "row_key", "_row", "_text", "failures", "group"):
        clash = clash.withColumn(name, F.lit("extra"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for folder, frame in (("clash", clash), ("none", clash.limit(0))):
        docs = frame
        for name, stage in corpus_pipeline.STAGES:
            before, path = docs.columns, str(tmp_path / folder / name)
            stage(spark, docs, str(tmp_path)).write.parquet(path)
            docs = spark.read.parquet(path)
            assert docs.columns[: len(before)] == before, name
        assert docs.count() == 0 if folder == "none" else docs.count() > 10
