"""WARC archives and the capture index merged out of them.

Pages become WARC/1.1 records, one text row each, written by Spark's text sink with the
record end as line separator: gzip files that any store and any committer can hold.
Reading them back gives one index run per file, sorted where it was read.  The runs
are cut at common splitters, and each key range is merged out of its run pieces by a
loser tree, so the ranges one after the other are the captures in order of URL key
and time.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.tables import map_batches, scratch_path, stored

#: Payload bytes from which an equal payload is not stored again.
LEAST_BYTES = 0
#: Records of a file, captures of a merged range, and keys that the splitters are chosen from.
FILE_RECORDS, RANGE_CAPTURES, SPLITTER_SAMPLE = 1_000, 50_000, 20_000
#: Capture times: pages without one count seconds from here by their id.
FIRST_CAPTURE = 1_577_836_800  # 2020-01-01

_END = "\r\n\r\n"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(text: Column) -> Column:
    """Upper-case base32 of the SHA-1: every 20 bits are five hexadecimal digits and four characters."""
    hexed = F.sha1(text)
    characters = []
    for k in range(8):
        bits = F.conv(F.substring(hexed, 5 * k + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1
            characters.append(F.substr(F.lit(_BASE32), at, F.lit(1)))
    return F.concat(*characters)


def url_key(url: Column) -> Column:
    """Host labels in reverse order, then the rest, in lower case."""
    low = F.lower(F.coalesce(url, F.lit("")))
    host = F.regexp_extract(low, r"^[a-z][a-z0-9+.-]*://([^/:?#]*)", 1)
    rest = F.regexp_extract(low, r"^(?:[a-z][a-z0-9+.-]*://[^/?#]*)?(.*)$", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def plan_records(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``page_id``, ``url``, ``html`` (never null), ``digest`` and ``first`` (the page that a revisit refers to, else null)."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"))
    marks = rows.select("page_id", base32_sha1(F.col("html")).alias("digest"), F.octet_length("html").alias("n"))
    marks = stored(marks.where(F.col("n") >= least_bytes), "payloads")
    groups = marks.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("rows"))
    again = (
        marks.join(groups.where("rows > 1"), "digest")
        .where("first is not null and not (page_id <=> first)")
        .select(F.coalesce("page_id", F.lit(-1)).alias("_page"), "digest", "first")
        .distinct()
    )
    # Only revisits are looked up; digest and page together, as ids may repeat over other payloads.
    rows = rows.withColumn("digest", base32_sha1(F.col("html"))).withColumn("_page", F.coalesce("page_id", F.lit(-1)))
    return rows.join(again, ["_page", "digest"], "left").drop("_page")


def record(plan: DataFrame) -> DataFrame:
    """The text of each record, without the two line ends behind it."""
    revisit = F.col("first").isNotNull()
    crlf = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts], F.lit("\r\n"))
    page = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    seconds = F.lit(FIRST_CAPTURE) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9))
    size = F.octet_length("html")
    http = F.concat(
        crlf("HTTP/1.1 200 OK"), crlf("Content-Type: text/html; charset=UTF-8"), crlf("Content-Length: ", size.cast("string")), F.lit("\r\n")
    )
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(size)
    head = F.concat(
        crlf("WARC/1.1"),
        crlf("WARC-Type: ", F.when(revisit, "revisit").otherwise("response")),
        crlf("WARC-Record-ID: ", page(F.col("page_id"))),
        crlf("WARC-Date: ", F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        crlf("WARC-Target-URI: ", uri),
        crlf("WARC-Payload-Digest: sha1:", F.col("digest")),
        F.when(revisit, F.concat(crlf("WARC-Profile: ", _PROFILE), crlf("WARC-Refers-To: ", page(F.col("first"))))).otherwise(F.lit("")),
        crlf("Content-Type: application/http; msgtype=response"),
        crlf("Content-Length: ", length.cast("string")),
        F.lit("\r\n"),
    )
    return plan.select(F.concat(head, http, F.when(revisit, F.lit("")).otherwise(F.col("html"))).alias("value"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """One record for each row, in gzip files of ``FILE_RECORDS`` at most."""
    spark = pages.sparkSession
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    rows = record(plan_records(pages, least_bytes))
    rows.write.option("lineSep", _END).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


_HEADER = re.compile(rb"([A-Za-z-]+): ?([^\r\n]*)\r\n")


def parse(raw: bytes) -> Iterator[tuple[int, int, dict[bytes, bytes], bytes]]:
    """Offset, length, headers and block of each record of an archive's bytes."""
    at = 0
    while at < len(raw):
        stop = raw.index(b"\r\n\r\n", at) + 4
        headers = dict(_HEADER.findall(raw, raw.index(b"\r\n", at) + 2, stop))
        end = stop + int(headers[b"Content-Length"])
        if raw[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at {at} does not end where its length says")
        yield at, end + 4 - at, headers, raw[stop:end]
        at = end + 4


_ENTRY = (
    "url_key string, captured string, page_id long, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, file string, offset long, length long"
)
_NAMES = [part.split()[0] for part in _ENTRY.split(", ")]


def _key(url: str) -> str:
    low = url.lower()
    m = re.match(r"[a-z][a-z0-9+.-]*://([^/:?#]*)[^/?#]*", low)
    return ",".join(reversed(m.group(1).split("."))) + ")" + low[m.end() :] if m else ")" + low


def _entry(file: str, offset: int, length: int, headers: dict[bytes, bytes], block: bytes) -> tuple:
    page = lambda x: int(x[10:-1]) if len(x) > 11 else None
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(_HEADER.findall(http + b"\r\n"))[b"Content-Length"])
    digest = headers[b"WARC-Payload-Digest"].removeprefix(b"sha1:").decode()
    kind = headers[b"WARC-Type"].decode()
    if kind == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != digest or len(payload) != size:
            raise ValueError(f"{file} at {offset}: payload differs from its digest or length")
    refers = headers.get(b"WARC-Refers-To")
    return (
        _key(headers[b"WARC-Target-URI"].decode()),
        headers[b"WARC-Date"].decode(),
        page(headers[b"WARC-Record-ID"]),
        size,
        digest,
        kind,
        page(refers) if refers else None,
        file,
        offset,
        length,
    )


def _order(entry: tuple) -> tuple:
    return entry[0], entry[1], -1 if entry[2] is None else entry[2], entry[7], entry[8]


def _batch(rows: list[tuple], extra: list[tuple] = ()) -> dict:
    return dict(zip(_NAMES, zip(*rows))) if rows else {n: [] for n in _NAMES}


_TYPES = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]


def read_runs(spark, path: str) -> DataFrame:
    """The index entries of every archive with ``run`` (its file) and ``seq``, ascending in each run."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                file = batch.column("path")[k].as_py().rsplit("/", 1)[-1]
                raw = zlib.decompress(batch.column("content")[k].as_buffer(), wbits=31)
                entries = sorted((_entry(file, *x) for x in parse(raw)), key=_order)
                arrays = [pa.array(c, t) for c, t in zip(zip(*entries), _TYPES)]
                if arrays:
                    yield pa.RecordBatch.from_arrays(
                        [*arrays, pa.array(range(len(entries)), pa.int64())], names=[*_NAMES, "seq"]
                    )

    return map_batches(files, kernel, f"{_ENTRY}, seq long")


class LoserTree:
    """k-way merge: inner nodes keep the loser of their match, so a step replays one path.

    Runs are lists ascending by ``order``; equal entries come out in the order of runs.
    """

    def __init__(self, runs: list[list[tuple]], order=_order):
        self.runs, self.order = runs, order
        self.at = [0] * len(runs)
        self.heads = [self._head(r) for r in range(len(runs))]
        n = len(runs)
        self.losers = [0] * n
        winners = [0] * n + list(range(n))
        for node in range(n - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = winners[1] if n > 1 else 0

    def _head(self, run: int):
        at = self.at[run]
        return self.order(self.runs[run][at]) if at < len(self.runs[run]) else None

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def __iter__(self) -> Iterator[tuple]:
        n = len(self.runs)
        while n and self.heads[self.winner] is not None:
            run = self.winner
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            self.heads[run] = self._head(run)
            node = (run + n) // 2
            while node:
                if self._before(self.losers[node], run):
                    self.losers[node], run = run, self.losers[node]
                node //= 2
            self.winner = run


def merge_runs(runs: DataFrame) -> DataFrame:
    """All entries with ``range`` and ``place``: ascending by them is ascending by URL key, time and page.

    Splitters are whole keys with page and place, so captures of one URL can be any number
    of ranges.  They come from a bounded sample of the keys, which decides how even the
    ranges are and nothing else.
    """
    spark = runs.sparkSession
    key = ["url_key", "captured", "page_id", "file", "offset"]
    total = runs.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_CAPTURES))
    share = min(1.0, SPLITTER_SAMPLE / max(1, total))
    picked = runs.where(F.pmod(F.xxhash64("file", "offset"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    sample = sorted(
        (r.url_key, r.captured, -1 if r.page_id is None else r.page_id, r.file, r.offset)
        for r in picked.select(*key).limit(4 * SPLITTER_SAMPLE).collect()
    )
    splitters = sorted({sample[len(sample) * k // parts] for k in range(1, parts)}) if sample else []
    shared = spark.sparkContext.broadcast(splitters)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(*[batch.column(k).to_pylist() for k in key])
            ranges = [bisect_right(shared.value, (u, c, -1 if p is None else p, f, o)) for u, c, p, f, o in keys]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ranges, pa.int32())], names=[*batch.schema.names, "range"])

    pieces = map_batches(runs, cut, f"{_ENTRY}, seq long, range int")
    dealt = pieces.repartition(parts, "range").sortWithinPartitions("range", "file", "seq")

    def merged(number: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        by_run: dict[str, list[tuple]] = {}
        for row in rows:
            by_run.setdefault(row[7], []).append(row)
        out = list(LoserTree(list(by_run.values())))
        arrays = [pa.array(c, t) for c, t in zip(zip(*out), _TYPES)]
        yield pa.RecordBatch.from_arrays(
            [*arrays, pa.array([number] * len(out), pa.int32()), pa.array(range(len(out)), pa.int64())],
            names=[*_NAMES, "range", "place"],
        )

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows = None, []
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in _NAMES]
            for r, row in zip(batch.column("range").to_pylist(), zip(*columns)):
                if r != number:
                    if rows:
                        yield from merged(number, rows)
                    number, rows = r, []
                rows.append(row)
        if rows:
            yield from merged(number, rows)

    return map_batches(dealt, kernel, f"{_ENTRY}, range int, place long")


def round_trip(pages: DataFrame, path: str | None = None, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Writes the archives, reads them back and merges their index.

    A null or empty html is a payload of no bytes; null and odd URLs become empty or
    percent-encoded.  Rows with the page id of a response are responses; a row without an
    id revisits any equal payload that has one.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, least_bytes)
    return merge_runs(stored(read_runs(spark, path), "runs"))
