"""ANSI SQL for the registered queries, over the driver's base tables.

The change-log rules of :mod:`checks.change_log` are stated here a second time,
in SQL, without the JSON round trip.
"""

from __future__ import annotations

_LOG = """
raw AS (
  SELECT event_id, user_id, ts,
    CASE WHEN event_id % 103 = 0 THEN 't'
         WHEN event_type = 'signup' THEN 'c'
         WHEN event_type = 'view' THEN 'r'
         WHEN event_type = 'error' THEN 'd'
         ELSE 'u' END AS op,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE ' User ' || user_id || ' ' END AS name,
    CASE WHEN event_id % 13 = 0 THEN NULL
         WHEN event_id % 11 = 0 THEN 'no-at-sign'
         WHEN event_id % 19 = 0 THEN 'u' || user_id || '@a@b'
         WHEN event_id % 23 = 0 THEN 'nobody@'
         ELSE 'U' || user_id || '@D' || (event_id % 7) || '.Example.com ' END AS email,
    (epoch_us(ts) // 21600000000) * 21600000 AS ts_ms,
    event_id % 101 <> 0 AS ok
  FROM events
  WHERE event_id % 97 <> 0
),
bronze AS (
  SELECT
    CAST(user_id AS VARCHAR) AS kafka_key,
    'cdc.users' AS kafka_topic,
    CAST(user_id % 3 AS INTEGER) AS kafka_partition,
    CAST(event_id AS BIGINT) AS kafka_offset,
    ts AS kafka_timestamp,
    CASE WHEN ok THEN op END AS op,
    CASE WHEN ok THEN CAST(ts_ms AS BIGINT) END AS source_ts_ms,
    CASE WHEN ok THEN 'shop' END AS source_db,
    CASE WHEN ok THEN 'public' END AS source_schema,
    CASE WHEN ok THEN 'users' END AS source_table,
    CASE WHEN ok AND event_id % 5 <> 0 THEN CAST(event_id AS BIGINT) END AS source_lsn,
    CASE WHEN ok AND op IN ('u', 'd') THEN CAST(user_id AS INTEGER) END AS before_id,
    CASE WHEN ok AND op = 'u' THEN ' Old ' || user_id
         WHEN ok AND op = 'd' THEN name END AS before_name,
    CASE WHEN ok AND op = 'u' THEN 'old' || user_id || '@old.example.com'
         WHEN ok AND op = 'd' THEN email END AS before_email,
    CASE WHEN ok AND op <> 'd' THEN CAST(user_id AS INTEGER) END AS after_id,
    CASE WHEN ok AND op <> 'd' THEN name END AS after_name,
    CASE WHEN ok AND op <> 'd' THEN email END AS after_email,
    CASE WHEN ok THEN CAST(user_id AS INTEGER) END AS id,
    CASE WHEN NOT ok THEN 'UNKNOWN'
         WHEN op = 'c' THEN 'INSERT' WHEN op = 'u' THEN 'UPDATE'
         WHEN op = 'd' THEN 'DELETE' WHEN op = 'r' THEN 'SNAPSHOT'
         ELSE 'UNKNOWN' END AS op_type,
    'debezium-kafka' AS _source
  FROM raw
)"""

_RANK = (
    "ORDER BY source_ts_ms DESC NULLS LAST, source_lsn DESC NULLS LAST, "
    "kafka_offset DESC NULLS LAST"
)


def _latest(name: str, where: str = "TRUE") -> str:
    """CTE with the newest event per id among the bronze rows that meet ``where``."""
    return f"""
{name} AS (
  SELECT id, trim(raw_name) AS name, lower(trim(raw_email)) AS email,
    CASE WHEN raw_email LIKE '%@%' THEN lower(split_part(trim(raw_email), '@', 2)) END
      AS email_domain,
    source_ts_ms, make_timestamp(source_ts_ms * 1000) AS source_ts,
    kafka_timestamp AS bronze_ingested_at, source_lsn, kafka_offset, op_type
  FROM (
    SELECT *, coalesce(after_name, before_name) AS raw_name,
      coalesce(after_email, before_email) AS raw_email,
      row_number() OVER (PARTITION BY id {_RANK}) AS rn
    FROM bronze WHERE id IS NOT NULL AND {where}
  ) WHERE rn = 1
)"""


_SILVER = _latest("newest") + ",\nsilver AS (SELECT * FROM newest WHERE op_type <> 'DELETE')"
_DAILY = """
daily AS (
  SELECT CAST(make_timestamp(source_ts_ms * 1000) AS DATE) AS change_date, op_type,
    CAST(COUNT(*) AS BIGINT) AS event_count
  FROM bronze WHERE source_ts_ms IS NOT NULL
  GROUP BY 1, 2
)"""
_DOMAINS = """
domains AS (
  SELECT email_domain, CAST(COUNT(*) AS BIGINT) AS user_count
  FROM silver WHERE email_domain IS NOT NULL GROUP BY email_domain
)"""


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + select.strip()


_SILVER_ROWS = "SELECT id, name, email, email_domain, source_ts_ms, source_ts FROM silver"

BRONZE = _with(_LOG, select="SELECT * FROM bronze")
SILVER = _with(_LOG, _SILVER, select=_SILVER_ROWS)
DOMAIN = _with(_LOG, _SILVER, _DOMAINS, select="SELECT * FROM domains")
DAILY = _with(_LOG, _DAILY, select="SELECT * FROM daily")

# The reference merge over the history in two batches, initial loads first:
# three ordered clauses over a full join.
_MERGED = """
target AS (SELECT * FROM loads WHERE op_type <> 'DELETE'),
merged AS (
  SELECT
    CASE WHEN t.id IS NULL AND s.op_type = 'DELETE' THEN 'drop'
         WHEN t.id IS NULL THEN 'source'
         WHEN s.id IS NULL THEN 'target'
         WHEN s.op_type = 'DELETE' THEN 'drop'
         WHEN s.source_ts_ms >= coalesce(t.source_ts_ms, 0) THEN 'source'
         ELSE 'target' END AS pick,
    t AS t_row, s AS s_row
  FROM target t FULL JOIN changes s ON t.id = s.id
),
picked AS (
  SELECT CASE WHEN pick = 'source' THEN s_row ELSE t_row END AS r
  FROM merged WHERE pick <> 'drop'
)"""

_SEED = """
seed AS (
  SELECT CAST(c_custkey AS INTEGER) AS id,
    trim(c_name) || ' ' || trim(c_mktsegment) AS name,
    lower(trim(c_name) || '.' || trim(c_mktsegment) || '@example.com') AS email
  FROM customer
)"""

ORACLES: dict[str, str] = {
    "bronze_flatten": BRONZE,
    "bronze_append_idempotent": BRONZE,
    "bronze_append_offsets": BRONZE,
    "compact_bronze": BRONZE,
    "stream_bronze": BRONZE,
    "silver_latest": SILVER,
    "silver_latest_max_by": SILVER,
    "silver_incremental": SILVER,
    "merge_ordered": SILVER,
    "stream_silver": SILVER,
    "gold_email_domain": DOMAIN,
    "stream_gold_domain": DOMAIN,
    "gold_daily_changes": DAILY,
    "gold_daily_incremental": DAILY,
    "stream_gold": DAILY,
    "op_mix": _with(
        _LOG,
        select="""
SELECT op_type, CAST(COUNT(*) AS BIGINT) AS event_count,
  make_timestamp(MIN(source_ts_ms) * 1000) AS first_event,
  make_timestamp(MAX(source_ts_ms) * 1000) AS last_event
FROM bronze GROUP BY op_type ORDER BY event_count DESC, op_type""",
    ),
    "op_counts": _with(
        _LOG,
        select="""
SELECT op_type, CAST(COUNT(*) AS BIGINT) AS event_count
FROM bronze GROUP BY op_type ORDER BY event_count DESC, op_type""",
    ),
    "daily_activity": _with(
        _LOG, _DAILY, select="SELECT * FROM daily ORDER BY change_date, op_type"
    ),
    "report_daily_30": _with(
        _LOG,
        _DAILY,
        select="SELECT * FROM daily ORDER BY change_date DESC NULLS LAST, op_type LIMIT 30",
    ),
    "latest_events_20": _with(
        _LOG,
        select=f"""
SELECT id, op_type, after_name, after_email,
  make_timestamp(source_ts_ms * 1000) AS source_ts, kafka_timestamp
FROM bronze {_RANK} LIMIT 20""",
    ),
    "sample_users_20": _with(
        _LOG,
        _SILVER,
        select="SELECT id, name, email, email_domain, source_ts FROM silver ORDER BY id LIMIT 20",
    ),
    "sample_users_10": _with(
        _LOG,
        _SILVER,
        select="SELECT id, name, email, email_domain, source_ts FROM silver ORDER BY id LIMIT 10",
    ),
    "silver_kpis": _with(
        _LOG,
        _SILVER,
        select="""
SELECT CAST(COUNT(*) AS BIGINT) AS total_users,
  CAST(COUNT(DISTINCT email_domain) AS BIGINT) AS unique_domains,
  MIN(source_ts) AS earliest_record, MAX(source_ts) AS latest_record,
  MAX(bronze_ingested_at) AS silver_last_built
FROM silver""",
    ),
    "quality_checks": _with(
        _LOG,
        _SILVER,
        select="""
SELECT CAST(SUM(CASE WHEN name IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_names,
  CAST(SUM(CASE WHEN email IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_emails,
  CAST(SUM(CASE WHEN email NOT LIKE '%@%' THEN 1 ELSE 0 END) AS BIGINT) AS bad_emails,
  CAST(COUNT(*) AS BIGINT) AS total_rows
FROM silver""",
    ),
    "domain_share": _with(
        _LOG,
        _SILVER,
        _DOMAINS,
        select="""
SELECT email_domain, user_count,
  CAST(ROUND(user_count * 100.0 / SUM(user_count) OVER (), 2) AS DOUBLE) AS pct
FROM domains ORDER BY user_count DESC, email_domain LIMIT 20""",
    ),
    "domain_share_all": _with(
        _LOG,
        _SILVER,
        _DOMAINS,
        select="""
SELECT email_domain, user_count,
  CAST(ROUND(user_count * 100.0 / SUM(user_count) OVER (), 2) AS DOUBLE) AS pct_of_total
FROM domains ORDER BY user_count DESC, email_domain""",
    ),
    "layer_counts": _with(
        _LOG,
        _SILVER,
        _DOMAINS,
        _DAILY,
        select="""
SELECT 'bronze.users_raw' AS layer, CAST(COUNT(*) AS BIGINT) AS rows FROM bronze
UNION ALL SELECT 'silver.users_clean', CAST(COUNT(*) AS BIGINT) FROM silver
UNION ALL SELECT 'gold.users_email_domain', CAST(COUNT(*) AS BIGINT) FROM domains
UNION ALL SELECT 'gold.users_daily_changes', CAST(COUNT(*) AS BIGINT) FROM daily""",
    ),
    "freshness": _with(
        _LOG,
        _SILVER,
        _DAILY,
        select="""
SELECT (SELECT MAX(kafka_timestamp) FROM bronze) AS bronze_last_ingest,
  (SELECT MAX(source_ts) FROM silver) AS silver_last_build,
  (SELECT MAX(CAST(change_date AS TIMESTAMP)) FROM daily) AS gold_last_build""",
    ),
    "seed_users": _with(_SEED, select="SELECT * FROM seed"),
    "insert_if_absent": """
WITH offered AS (
  SELECT CAST(o_custkey AS INTEGER) AS id,
    trim(o_orderstatus) || ' ' || trim(o_orderpriority) AS name,
    lower(trim(o_orderstatus) || '.' || trim(o_orderpriority) || '@example.com') AS email
  FROM orders
), first_offer AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY name, email) AS rn FROM offered
)
SELECT id, name, email FROM first_offer o
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = o.id)""".strip(),
    "merge_upsert_delete": _with(
        _LOG,
        _latest("loads", "op_type IN ('SNAPSHOT', 'INSERT')"),
        _latest("changes", "op_type NOT IN ('SNAPSHOT', 'INSERT')"),
        _MERGED,
        select="""
SELECT r.id AS id, r.name AS name, r.email AS email, r.email_domain AS email_domain,
  r.source_ts_ms AS source_ts_ms, r.source_ts AS source_ts
FROM picked""",
    ),
    "window_changes_5m": """
WITH w AS (
  SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, event_type
  FROM events
)
SELECT window_start, window_start + INTERVAL '5 minutes' AS window_end,
  event_type AS op_type, CAST(COUNT(*) AS BIGINT) AS event_count
FROM w GROUP BY window_start, event_type""".strip(),
}

# The same tables by other ways.
ORACLES |= {
    "stream_window_changes_5m": ORACLES["window_changes_5m"],
    "bronze_append_gaps": ORACLES["bronze_flatten"],
    "ingest_empty_scan": ORACLES["bronze_flatten"],
    "silver_two_writers": ORACLES["silver_latest"],
    "transform_full": ORACLES["silver_latest"],
    "stream_restart": ORACLES["silver_latest"],
    "run_all_layers": ORACLES["layer_counts"],
    "report_section_bronze": ORACLES["op_mix"],
    "report_section_silver": ORACLES["quality_checks"],
    "report_section_gold": ORACLES["domain_share"],
    "seed_table_twice": ORACLES["seed_users"],
}

_VISITORS = """
visitors AS (
  SELECT * REPLACE ('cdc.visitors' AS kafka_topic) FROM bronze WHERE CAST(kafka_key AS BIGINT) % 2 = 0
)"""

# Silver by key, and what streams keep as state.
ORACLES |= {
    "merge_keyed_upsert_delete": ORACLES["merge_upsert_delete"],
    "merge_keyed_ordered": ORACLES["silver_latest"],
    "gold_domain_by_deltas": ORACLES["gold_email_domain"],
    "stream_keyed_silver": ORACLES["silver_latest"],
    "stream_newest_rows": ORACLES["silver_latest"],
    "stream_newest_rows_expiring": ORACLES["silver_latest"],
    "stream_replayed_log": ORACLES["bronze_flatten"],
    "stream_observed_ops": ORACLES["op_counts"],
    "stream_topics_bronze": _with(
        _LOG, _VISITORS, select="SELECT * FROM bronze UNION ALL SELECT * FROM visitors"
    ),
    "stream_topics_domains": _with(
        _LOG,
        _SILVER,
        select="""
SELECT t.topic, email_domain, CAST(COUNT(*) AS BIGINT) AS user_count
FROM silver JOIN (VALUES ('cdc.users', 1), ('cdc.visitors', 2)) AS t(topic, step) ON id % t.step = 0
WHERE email_domain IS NOT NULL GROUP BY t.topic, email_domain""",
    ),
    "stored_offset_runs": _with(
        _LOG,
        select="""
, placed AS (
  SELECT kafka_topic, kafka_partition, kafka_offset // 4096 AS block, kafka_offset,
    kafka_offset - row_number() OVER (PARTITION BY kafka_partition, kafka_offset // 4096 ORDER BY kafka_offset) AS island
  FROM bronze
)
SELECT kafka_topic, kafka_partition, block, MIN(kafka_offset) AS first_offset, MAX(kafka_offset) AS last_offset
FROM placed GROUP BY kafka_topic, kafka_partition, block, island""",
    ),
    "silver_kpis_kept": _with(
        _LOG,
        _SILVER,
        select="""
SELECT CAST(COUNT(*) AS BIGINT) AS total_users,
  CAST(COUNT(DISTINCT email_domain) AS BIGINT) AS unique_domains,
  MIN(source_ts) AS earliest_record, MAX(source_ts) AS latest_record
FROM silver""",
    ),
    "latest_events_20_kept": ORACLES["latest_events_20"],
    "bronze_figures_from_footers": _with(
        _LOG,
        select="""
SELECT CAST(COUNT(*) AS BIGINT) AS rows, MIN(source_ts_ms) AS min_source_ts_ms, MAX(source_ts_ms) AS max_source_ts_ms,
  MIN(kafka_offset) AS min_kafka_offset, MAX(kafka_offset) AS max_kafka_offset
FROM bronze""",
    ),
    "stream_window_late_5m": ORACLES["window_changes_5m"],
}
