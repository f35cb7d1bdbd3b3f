"""Registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import (
    byte_bpe,
    decontaminate,
    importance,
    licenses,
    lm_score,
    minhash,
    pii,
    pu_classifier,
    quality_rules,
    repeats,
    simhash,
    spelling,
    warc,
)
from tidelog.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Rank file of the byte-level vocabulary, below the public tokenizers' folder.
RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rank_file(name: str = RANK_FILE) -> tuple[dict[bytes, int], str]:
    """Ranks and splitting pattern of a public vocabulary."""
    import public_tokenizers

    return byte_bpe.load_ranks(public_tokenizers.path(name)), public_tokenizers.PATTERN


@query
def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"), *rank_file())


@query
def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = warc.round_trip(table(spark, sf_dir, "pages"))
    return merged.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured")


ORACLES["op5_warc"] = r"""
WITH p AS (
  SELECT page_id, lower(coalesce(url, '')) AS u, coalesce(html, '') AS h FROM pages
), d AS (
  SELECT page_id, u, strlen(h)::BIGINT AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((
      ('0x' || substr(sha1(h), 5 * (i // 4)::INTEGER + 1, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31), 1)), '') AS payload_digest
  FROM p
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM d
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to,
  array_to_string(list_reverse(string_split(regexp_extract(u, '^[a-z][a-z0-9+.-]*://([^/:?#]*)', 1), '.')), ',') || ')' ||
    regexp_extract(u, '^(?:[a-z][a-z0-9+.-]*://[^/?#]*)?(.*)$', 1) AS url_key,
  strftime(make_timestamp((1577836800 + page_id) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS captured
FROM f
"""


@query
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents lie in folders by source and id: ``/source/id div 4096/id div 64/id``."""
    docs = table(spark, sf_dir, "documents")
    level = lambda n: F.floor(F.col("doc_id") / n).cast("string")
    path = F.concat_ws("/", F.lit(""), "source", level(4096), level(64), F.col("doc_id").cast("string"))
    found = licenses.scan(docs.select(path.alias("path"), "text"))
    return found.withColumn("doc_id", F.regexp_extract("path", "([0-9]+)$", 1).cast("long"))


def _license_oracle() -> str:
    vectors = ", ".join(f"('{t}', {k}, '{name}', {w!r})" for t, k, name, w in licenses.vectors())
    idf, other = licenses.weights()
    weights = ", ".join(f"('{t}', {w!r})" for t, w in sorted(idf.items()))
    return rf"""
WITH tv(term, k, lic, w) AS (VALUES {vectors}), idf(term, w) AS (VALUES {weights}), d AS (
  SELECT doc_id, '/' || source || '/' || (doc_id // 4096) || '/' || (doc_id // 64) || '/' || doc_id AS path, coalesce(text, '') AS x FROM documents
), p AS (
  SELECT path, list_concat(list_concat([x],
    list_filter(string_split(regexp_replace(x, '{licenses.SENTENCE_END}', '' || chr(10), 'g'), chr(10)), lambda l: regexp_matches(l, '{licenses.HINT}'))),
    list_filter(string_split(regexp_replace(x, '{licenses.BLOCK_END}', chr(1), 'g'), chr(1)), lambda l: regexp_matches(l, '{licenses.HINT}'))) AS ps
  FROM d WHERE regexp_matches(x, '{licenses.HINT}')
), q AS (
  SELECT path, unnest(range(len(ps))) AS piece, unnest(ps) AS said FROM p
), ht AS (
  SELECT path, piece, unnest(regexp_extract_all(lower(said), '{licenses.TERM}')) AS term FROM q
), hw AS (
  SELECT path, piece, ht.term, count(*) * coalesce(any_value(w), {other!r}) AS w FROM ht LEFT JOIN idf USING (term) GROUP BY path, piece, ht.term
), hn AS (
  SELECT path, piece, sqrt(sum(w * w)) AS n FROM hw GROUP BY path, piece
), sc AS (
  SELECT hw.path, hw.piece, k, lic, round(sum(hw.w * tv.w) / any_value(n), 6) AS s
  FROM hw JOIN tv USING (term) JOIN hn ON hw.path = hn.path AND hw.piece = hn.piece GROUP BY hw.path, hw.piece, k, lic
), best AS (
  SELECT path, lic, s, max(CASE WHEN piece = 0 THEN s END) OVER (PARTITION BY path) AS whole
  FROM sc WHERE s >= {licenses.LEAST_SIMILARITY}
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY lic = '{licenses.NO_LICENCE}', s DESC, k) = 1
), o AS (
  SELECT path, lic, s, coalesce(whole, 0) >= {licenses.FILE_SIMILARITY} AS is_file FROM best
), held AS (
  SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder, lic FROM o WHERE is_file
  QUALIFY row_number() OVER (PARTITION BY regexp_extract(path, '^(.*)/[^/]*$', 1) ORDER BY s DESC, path) = 1
), near AS (
  SELECT d.path, held.folder, held.lic
  FROM d JOIN held ON starts_with(d.path, held.folder || '/')
  QUALIFY row_number() OVER (PARTITION BY d.path ORDER BY length(held.folder) DESC) = 1
)
SELECT d.path, coalesce(o.lic, near.lic) AS licence, o.s AS similarity,
  CASE WHEN o.lic IS NOT NULL AND o.is_file THEN 'file' WHEN o.lic IS NOT NULL THEN 'header'
       WHEN near.lic IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
  CASE WHEN o.lic IS NULL THEN near.folder END AS inherited_from, d.doc_id
FROM d LEFT JOIN o USING (path) LEFT JOIN near USING (path)
"""


ORACLES["op6_licenses"] = _license_oracle()


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"))
    judged = quality_rules.apply_policy(rows, quality_rules.PROSE)
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"),
        "kept",
        "failures",
    )


# Window by window: the places of a repeated three-word window, each counted once.
ORACLES["op7_quality_rules"] = r"""
WITH t AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS x FROM documents
), w AS (
  SELECT k, doc_id, x, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM t
), s AS (
  SELECT k, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS win
  FROM (SELECT k, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w)
), r AS (
  SELECT k, i FROM s QUALIFY count(*) OVER (PARTITION BY k, win) > 1
), p AS (
  SELECT k, count(DISTINCT i + d) AS n FROM r, (VALUES (0), (1), (2)) AS o(d) GROUP BY k
), m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words,
         coalesce(length(array_to_string(ws, '')), 0)::BIGINT AS word_chars,
         length(regexp_replace(x, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(p.n, 0)::BIGINT AS n_repeat_words,
         len(ls) AS n_lines,
         length(regexp_replace(x, '[^A-Z]', '', 'g')) AS n_capitals
  FROM w LEFT JOIN p USING (k)
), f AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 25 * n_words THEN 4 ELSE 0 END
    + CASE WHEN 100 * n_capitals > 50 * word_chars THEN 8 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 60 * n_lines THEN 16 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 32 ELSE 0 END)::INTEGER AS failures
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failures & 3) <> 0 AS base_failed, failures = 0 AS kept, failures
FROM f
"""


@query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pu_classifier.score(docs, pu_classifier.fit(docs, table(spark, sf_dir, "labels")))


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), *rank_file())


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    written = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", written.alias("fingerprint"), "component_id")


@query
def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2)


@query
def op12_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))
