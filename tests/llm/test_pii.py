"""Identifiers: plain ones against the patterns as they stand, disguised ones against planted spans."""

import random
import re

import pytest

from tidelog.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain(text):
    found = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if ok:
                found.append((k, *m.span()))
    return found


@pytest.mark.parametrize("seed", range(40))
def test_plain_identifiers_are_the_patterns_matches(seed):
    rnd = random.Random(seed)
    parts = ["a", "b.", "@", ".", "-", "+1", " ", "(", ")", "12", "255", "300", "7", "4465758382889437", "x@y.z", "é", "\n", "%", "1.2.3.4", "+49 30 123456"]
    for _ in range(200):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(30)))
        assert pii.detect(text) == plain(text), text


@pytest.mark.parametrize(
    "kind, disguise",
    [
        ("email", "jo.doe [at] mail [dot] example (dot) com"),
        ("email", "jo at example dot com"),
        ("email", "jо@exаmple.com"),
        ("email", "jo​e@exam​ple.com"),
        ("email", "jo@example dot org"),
        ("email", "jo(at)example.com"),
        ("phone", "plus one five five five one two three four five six seven"),
        ("phone", "+4​9 30 123456"),
        ("card", "four four six five seven five eight three eight two eight eight nine four three seven"),
        ("card", "４４６５７５８３８２８８９４３７"),
        ("ip", "one nine two dot one six eight dot one dot two"),
        ("ip", "１０.0.0.1"),
    ],
)
def test_disguised_identifiers_map_back_to_their_source(kind, disguise):
    before, after = "Write to: ", " , please."
    base, every = pii.spans(before + disguise + after)
    added = [s for s in every if s not in base]
    wanted = pii.KINDS.index(kind)
    assert any(
        k == wanted and s <= len(before) + 3 and e == len(before) + len(disguise) for k, s, e in every
    ), (base, every)
    assert added


@pytest.mark.parametrize(
    "kind, disguise",
    [
        ("email", "jоhn@example.com"),
        ("email", "jo\u200bhn@example.com"),
        ("email", "john [dot] smith@example.com"),
        ("email", "john@example.cоm"),
        ("email", "john (chez) example.com"),
        ("email", "john [klammeraffe] example.com"),
        ("email", "john<@>host.com"),
        ("email", "john( \tat )host.com"),
        ("email", "john [at] host[ dot ]com"),
        ("phone", "plus one two one six two one one two six two one"),
        ("email", "juan arroba ejemplo punto com"),
        ("email", "anna klammeraffe firma punkt de"),
        ("email", "luc arobase exemple point fr"),
        ("email", "john at example dot shop"),
        ("email", "john at mail dot example dot photography"),
        ("email", "𝗷𝗼𝗵𝗻@𝗲𝘅𝗮𝗺𝗽𝗹𝗲.com"),
        ("email", "ⓙⓞⓗⓝ@example.com"),
        ("email", "ⱼohn@exampleﹺcom".replace("ﹺ", "．")),
        ("ip", "192 dot 168 dot 0 dot 1"),
        ("ip", "10 punto 0 punto 12 punto 255"),
        ("ip", "①⓪.0.0.1".replace("⓪", "０")),
        ("phone", "plus one double five triple two six seven eight"),
        ("phone", "plus drei vier fünf sechs sieben acht neun null"),
        ("phone", "plus uno dos tres cuatro cinco seis siete ocho"),
        ("phone", "plus zéro un deux trois quatre cinq sept huit"),
    ],
)
def test_the_whole_disguise_is_a_span_and_redacted(kind, disguise):
    text = f"Write to: {disguise} , please."
    base, every = pii.spans(text)
    assert (pii.KINDS.index(kind), 10, 10 + len(disguise)) in every, (base, every)
    assert pii.redacted(text, every) == f"Write to: <{kind}> , please."


@pytest.mark.parametrize(
    "text",
    [
        "", "   ", "he was at home. dot", "one two three", "at the dot of noon", "x@y", "1.2.3", "a@b@c",
        "Meet at noon at the point of no return.", "<at> and (dot)", "​", "Look at the dot of noon", "Il est chez lui point final",
        "Er kam an einem Punkt an dem", "double one two three", "x² + y² = z²", "Section 3 point 2 point 1", "at home dot the end",
    ],
)
def test_clean_text_has_no_identifier(text):
    assert pii.spans(text)[1] == []


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 100_000, "+1" * 100_000, "at dot " * 40_000, "one " * 60_000):
        pii.spans(text)


def test_redaction_leaves_the_rest():
    text = "Call +1 (523) 555-1055 or jo@example.com, or jo at example dot com."
    assert pii.redacted(text, pii.spans(text)[1]) == "Call <phone> or <email>, or <email>."


def test_rows(spark):
    rows = [(1, "jo@example.com", "x"), (2, None, "y"), (3, "", "z"), (1, "jo@example.com", "x"), (None, "10.0.0.1", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = {(r.doc_id, r.n_email, r.n_ip, r.spans) for r in pii.find(docs).collect()}
    assert got == {(1, 1, 0, "email:0:14"), (2, 0, 0, ""), (3, 0, 0, ""), (None, 0, 1, "ip:0:8")}
    assert pii.find(docs).count() == 5
    assert pii.find(docs.limit(0)).count() == 0
    assert [r.text for r in pii.redact(docs).orderBy("spans").collect()][1:3] == ["<email>", "<email>"]
