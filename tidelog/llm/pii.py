"""Personal data behind disguises, with offsets into the source text.

Plain identifiers are found in the text as it is.  Then transducers rewrite
look-alike letters, invisible characters, spelled digits and at/dot disguises; each
rewriting remembers which source characters it stands for, so what is found in the
rewritten text maps back to a span of the source.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.tables import map_batches, texts

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # kind, start, end in code points

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never starts inside a run of digits: where the run's head fails, so does its rest.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def _emails(text: str) -> list[Span]:
    """Each @ with the run before it and a domain behind it; one look at every character."""
    found, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            floor = domain.end()
            found.append((0, start, floor))
        at = text.find("@", max(floor, at + 1))
    return found


def detect(text: str) -> list[Span]:
    """Plain identifiers, leftmost and not overlapping in each kind; by kind, then start."""
    found = _emails(text)
    if not text.isascii() or any(d in text for d in "0123456789"):
        found += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and _luhn(digits):
                found.append((2, *m.span()))
        if "+" in text:
            found += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return found


# Letters of other scripts that look like Latin ones.
_LOOKALIKES = dict(
    zip(
        "аеорсухіјѕԁһӏԛԝАВЕКМНОРСТУХІЈЅαονρικτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧɡı",
        "aeopcyxijsdhlqwABEKMHOPCTYXIJSaovpiktuxABEZHIKMNOPTYXgi",
    )
)
# Full-width forms stand 0xFEE0 above ASCII; some signs have wide or small twins as well.
_LOOKALIKES |= {chr(c + 0xFEE0): chr(c) for c in range(0x21, 0x7F)}
_LOOKALIKES |= {"﹫": "@", "。": ".", "․": ".", "‐": "-", "‑": "-", "–": "-", "−": "-", " ": " ", " ": " "}
# Letters, digits and signs that decompose into one ASCII character: mathematical, circled, raised and other forms.
for _c in (*range(0xAA, 0x250), *range(0x1D2C, 0x1D70), *range(0x2070, 0x2190), *range(0x2460, 0x2500), *range(0x2C7C, 0x2C7E), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F190)):
    _form = unicodedata.normalize("NFKC", chr(_c))
    if len(_form) == 1 and "!" <= _form <= "~":
        _LOOKALIKES.setdefault(chr(_c), _form)
_INVISIBLE = "​‌‍⁠﻿­"
_ODD_CHARACTERS = frozenset([*_LOOKALIKES, *_INVISIBLE, *"٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹०१२३४५६७८९"])
_ODD_CHARACTER = re.compile("[" + "".join(map(re.escape, _LOOKALIKES)) + _INVISIBLE + "٠-٩۰-۹०-९]")

# Digits as words, in the languages of the corpus.
_DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4",
    "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4",
    "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4",
    "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4",
    "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_AT = "at|@|arroba|chez|klammeraffe"
_DOT = r"dot|\.|punkt|punto|point"
_OPEN, _SHUT = r"[\[({<]", r"[\])}>]"
_BRACKETED_AT = re.compile(rf"\s*{_OPEN}\s*(?:{_AT})\s*{_SHUT}\s*", re.I)
_BRACKETED_DOT = re.compile(rf"\s*{_OPEN}\s*(?:{_DOT})\s*{_SHUT}\s*", re.I)
_BRACKETED = re.compile(rf"{_OPEN}\s*(?:{_AT}|{_DOT})\s*{_SHUT}", re.I)
# At and dot as they are said, and words that no spoken host or ending is.
_SAID_AT, _SAID_DOT = "at|arroba|arobase|chez|klammeraffe", "dot|punkt|punto|point"
_NO_LABEL = frozenset(
    "the a an this that these those my your his her its our their of on in to is was are and or for with by from final home work "
    "le la les un une des ce cette mon ton son nous vous lui elle et ou de du sur dans est "
    "der die das ein eine dem den des und oder von zu im am ist mein dein sein "
    "el los las una unos este esta mi tu su y o del al en es final".split()
)
# Country endings that are such words as well.
_COUNTRIES = frozenset("de es fr it at in is no la".split())
_NAME = r"[A-Za-z0-9._%+-]+"
_LABEL = r"[A-Za-z0-9-]+"
_SPOKEN_DOT = rf"\s+(?:{_SAID_DOT})\s+"
# Bare words count only as a whole address: "name at host dot tld", or "name@host dot tld".
_SPOKEN = re.compile(
    rf"(?<![A-Za-z0-9._%+-]){_NAME}(\s+(?:{_SAID_AT})\s+|@)({_LABEL}(?:\.{_LABEL})*)((?:{_SPOKEN_DOT}{_LABEL})*?{_SPOKEN_DOT}([A-Za-z]{{2,}}))(?![A-Za-z0-9-]|{_SPOKEN_DOT}{_LABEL})",
    re.I,
)
_SPOKEN_DOT = re.compile(_SPOKEN_DOT, re.I)
_DOT_WORDS = frozenset(_SAID_DOT.split("|"))
_DIGIT = "(?:" + "|".join(sorted(_DIGIT_WORDS, key=len, reverse=True)) + "|[0-9])"
# A digit said twice or three times.
_TIMES = {"double": 2, "triple": 3, "doble": 2, "doppel": 2}
_SOME = rf"(?:(?:{'|'.join(_TIMES)})[\s-]*)?{_DIGIT}"
_SAID = re.compile(
    rf"(?<!\w)(?:plus[\s-]+|\+\s?)?{_SOME}(?:(?:[\s,-]{{1,3}}|\s+(?:{_SAID_DOT})\s+){_SOME}){{4,}}(?!\w)", re.I
)
_SAID_PART = re.compile(rf"plus|\+|{_SAID_DOT}|{'|'.join(_TIMES)}|(?<![^\W_]){_DIGIT}(?!\w)", re.I)
# Words of spoken numbers, of which such a number has three in a row at least, whatever stands around it.
_NUMBER_WORDS = frozenset([*_DIGIT_WORDS, *_TIMES, *_DOT_WORDS, "plus", "+", *"0123456789"])
#: Digits that a spoken number has at least.
_LEAST_SAID = 7
# Groups of digits with spoken dots between them: "192 dot 168 dot 0 dot 1".
_GROUPS = re.compile(rf"(?<!\w)[0-9]{{1,3}}(?:\s+(?:{_SAID_DOT})\s+[0-9]{{1,3}}){{3}}(?!\w)", re.I)


class _Rewritten:
    """A text with the source span of each of its parts."""

    def __init__(self, text: str):
        self.text = text
        self.at = [0]  # where each part starts in ``text``
        self.parts = [(0, len(text), True)]  # its source span; whether it is the source's own characters

    def source(self, start: int, end: int) -> tuple[int, int, bool]:
        """Source span of [start, end), and whether any character in it was rewritten."""
        first, last = bisect_right(self.at, start) - 1, bisect_right(self.at, end - 1) - 1
        a, b = self.parts[first], self.parts[last]
        left = a[0] + (start - self.at[first] if a[2] else 0)
        right = b[0] + end - self.at[last] if b[2] else b[1]
        return left, right, not all(p[2] for p in self.parts[first : last + 1]) or last > first

    def rewrite(self, changes: list[tuple[int, int, str]]) -> None:
        """Replaces spans (ascending, apart) of the present text."""
        pieces, at, parts, done, size = [], [], [], 0, 0

        def keep(start: int, end: int) -> None:
            nonlocal size
            while start < end:
                k = bisect_right(self.at, start) - 1
                stop = min(end, self.at[k + 1] if k + 1 < len(self.at) else len(self.text))
                source, last, own = self.parts[k]
                at.append(size)
                parts.append((source + start - self.at[k], source + stop - self.at[k], True) if own else (source, last, False))
                pieces.append(self.text[start:stop])
                size += stop - start
                start = stop

        for start, end, new in changes:
            keep(done, start)
            left, right, _ = self.source(start, end)
            if new:
                at.append(size)
                parts.append((left, right, False))
                pieces.append(new)
                size += len(new)
            done = end
        keep(done, len(self.text))
        self.text, self.at, self.parts = "".join(pieces), at or [0], parts or [(0, 0, True)]


def _plain_character(c: str) -> str:
    if c in _INVISIBLE:
        return ""
    return _LOOKALIKES.get(c) or str(int(c))


def _said(m: re.Match) -> str:
    out, times = [], 1
    for part in _SAID_PART.findall(m.group()):
        p = part.lower()
        if p in _TIMES:
            times = _TIMES[p]
            continue
        out.append("+" if p in ("plus", "+") else (p if p.isdecimal() else _DIGIT_WORDS.get(p, ".")) * times)
        times = 1
    return "".join(out)


def _said_changes(text: str) -> list[tuple[int, int, str]]:
    made = [(*m.span(), _said(m)) for m in _SAID.finditer(text)]
    return [x for x in made if sum(c.isdecimal() for c in x[2]) >= _LEAST_SAID]


def _spoken_changes(text: str) -> list[tuple[int, int, str]]:
    changes = []
    for m in _SPOKEN.finditer(text):
        if m.group(4).lower() in _NO_LABEL - _COUNTRIES or m.group(2).lower() in _NO_LABEL:
            continue
        if m.group(1) != "@":
            changes.append((*m.span(1), "@"))
        changes += [(*d.span(), ".") for d in _SPOKEN_DOT.finditer(text, *m.span(3))]
    return changes


def _group_changes(text: str) -> list[tuple[int, int, str]]:
    return [(*d.span(), ".") for m in _GROUPS.finditer(text) for d in _SPOKEN_DOT.finditer(text, *m.span())]


def disguised(text: str, base: list[Span]) -> list[Span]:
    """Identifiers that only the rewritten text shows whole: no ``base`` span of their kind holds them."""
    steps: list = []
    if not text.isascii() and not _ODD_CHARACTERS.isdisjoint(text):
        steps.append(lambda t: [(*m.span(), _plain_character(m.group())) for m in _ODD_CHARACTER.finditer(t)])
    odd = bool(steps)  # what the later steps look for may only show when they are gone
    if odd or _BRACKETED.search(text):
        steps.append(lambda t: [(*m.span(), "@") for m in _BRACKETED_AT.finditer(t)])
        steps.append(lambda t: [(*m.span(), ".") for m in _BRACKETED_DOT.finditer(t)])
    words = text.lower().replace(",", " ").replace("-", " ").split()
    if odd or not _DOT_WORDS.isdisjoint(words):
        steps += [_spoken_changes, _group_changes]
    if odd or b"\1\1\1" in bytes(map(_NUMBER_WORDS.__contains__, words)):
        steps.append(_said_changes)
    if not steps:
        return []
    made = _Rewritten(text)
    changed = False
    for step in steps:
        if changes := step(made.text):
            made.rewrite(changes)
            changed = True
    if not changed:
        return []
    found = []
    for kind, start, end in detect(made.text):
        left, right, new = made.source(start, end)
        if kind == 0 and not made.text[start:end].rpartition(".")[2].isalpha():
            continue  # a rewritten mail address ends in letters
        if new and not any(k == kind and s <= left and right <= e for k, s, e in base):
            found.append((kind, left, right))
    return found


def spans(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and plain and disguised ones together; each by kind, then start."""
    base = detect(text)
    extra = disguised(text, base)
    return base, sorted(base + extra) if extra else base


def _written(found: list[Span]) -> str:
    return ",".join([f"{KINDS[k]}:{s}:{e}" for k, s, e in found])


def redacted(text: str, found: list[Span]) -> str:
    """The text with a placeholder for each span; spans that overlap share the first one's."""
    merged: list[list[int]] = []
    for start, end, kind in sorted((s, e, k) for k, s, e in found):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end, kind])
    pieces, done = [], 0
    for start, end, kind in merged:
        pieces += [text[done:start], f"<{KINDS[kind]}>"]
        done = end
    return "".join([*pieces, text[done:]])


def find(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, counts of plain identifiers, ``base_sha256`` of their spans, and ``spans`` with the disguised ones.

    A null or empty text has none.  Rows are looked at one by one.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digest, written, added = [[], [], [], []], [], [], []
            for body in texts(batch, "_text"):
                base, every = spans(body)
                for kind in range(4):
                    counts[kind].append(sum(1 for s in base if s[0] == kind))
                digest.append(hashlib.sha256(_written(base).encode()).hexdigest())
                written.append(_written(every))
                added.append(len(every) - len(base))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_key"),
                    *[pa.array(c, pa.int64()) for c in counts],
                    pa.array(digest, pa.string()),
                    pa.array(written, pa.string()),
                    pa.array(added, pa.int64()),
                ],
                names=[key, *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_disguised"],
            )

    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return map_batches(rows, kernel, f"`{key}` {kind}, {counts}, base_sha256 string, spans string, n_disguised long")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with placeholders in ``text`` (and ``n_chars``, if there, to match); a null text stays null.

    All columns are kept, whatever their names; rows are looked at one by one.
    """
    place = docs.columns.index(text)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cleaned = [None if x is None else redacted(x, spans(x)[1]) for x in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place), pa.array(cleaned, batch.schema.field(place).type))

    out = map_batches(docs, kernel, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(F.col(f"`{text}`")).cast(docs.schema["n_chars"].dataType))
    return out
