"""What each registered query must return, as DuckDB SQL over the given tables.

The SQL works from ``events`` alone: no message is encoded or parsed, except
where the message text itself is the result.
"""

from __future__ import annotations

# The feed of catalogue/feed.py: one row per message, its fields as sent.
_SENT = """
ev AS (
  SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k FROM events
),
sent AS (
  SELECT *, 0 AS copy FROM ev
  UNION ALL SELECT *, 1 FROM ev WHERE event_id % 50 = 0
  UNION ALL SELECT *, 2 FROM ev WHERE event_id % 97 = 0 AND event_id % 50 <> 0
  UNION ALL SELECT *, 3 FROM ev WHERE event_id % 200 = 7
),
fields AS (
  SELECT
    CAST(event_id AS VARCHAR) AS event_id,
    CASE WHEN event_id % 101 <> 0 THEN 'txn-' || event_id END AS transaction_id,
    user_id AS customer_id,
    user_id * 10 + event_id % 3 AS card_id,
    k AS merchant_id,
    'Merchant#' || k AS merchant_name,
    ['grocery', 'fuel', 'restaurant', 'travel', 'electronics', 'gaming', 'cash_advance',
     'luxury', 'subscription'][k % 9 + 1] AS merchant_category,
    CASE WHEN event_id % 97 = 0 AND copy <> 2 THEN -1 ELSE 1 END * round(value * 10, 2) AS amount,
    'USD' AS currency,
    ['US', 'GB', 'SE', 'DE', 'IN', 'NG', 'BR', 'AE', 'US', 'US'][(event_id * 7 + user_id) % 10 + 1]
      AS country,
    'City#' || (user_id % 20) AS city,
    CASE event_type WHEN 'view' THEN 'pos' WHEN 'error' THEN 'pos' WHEN 'signup' THEN 'atm'
      WHEN 'click' THEN 'ecommerce' WHEN 'purchase' THEN 'ecommerce' END AS channel,
    CASE WHEN event_type IN ('click', 'purchase') THEN 'dev-' || event_id END AS device_id,
    CASE WHEN event_type IN ('click', 'purchase') THEN '10.0.0.1' END AS ip_address,
    ts AS event_ts,
    copy,
    CAST((event_id + copy) % 4 AS INTEGER) AS kafka_partition,
    event_id // 4 + CAST(3 - copy AS BIGINT) * 1000000000 AS kafka_offset,
    ts + to_minutes(copy) AS kafka_timestamp,
    CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END
      + CASE copy WHEN 1 THEN 1 WHEN 2 THEN 1 + event_id % 2 ELSE 0 END AS step
  FROM sent
),
signals AS (
  SELECT *,
    amount >= 750 AS high_amount,
    country IN ('NG', 'BR', 'AE') AS risky_country,
    merchant_category IN ('cash_advance', 'gaming', 'luxury') AS risky_category,
    channel = 'ecommerce' AS card_not_present,
    hour(event_ts) IN (0, 1, 2, 3, 4) AS night_txn_utc
  FROM fields
),
scored AS (
  SELECT *,
    CAST(high_amount AS BIGINT) + CAST(risky_country AS BIGINT) + CAST(risky_category AS BIGINT)
      + CAST(card_not_present AS BIGINT) + CAST(night_txn_utc AS BIGINT) AS risk_score_hint
  FROM signals
),
payload AS (
  SELECT *, risk_score_hint >= 2 AS is_suspicious_hint,
    'fixture' AS producer_app, '1.0' AS schema_version
  FROM scored
)
"""

_TEXT_FIELDS = [
    "event_id", "transaction_id", "merchant_name", "merchant_category", "currency", "country",
    "city", "channel", "device_id", "ip_address", "producer_app", "schema_version",
]
_PAYLOAD_FIELDS = [
    "event_id", "transaction_id", "customer_id", "card_id", "merchant_id", "merchant_name",
    "merchant_category", "amount", "currency", "country", "city", "channel", "device_id",
    "ip_address", "event_ts", "high_amount", "risky_country", "risky_category",
    "card_not_present", "night_txn_utc", "risk_score_hint", "is_suspicious_hint",
    "producer_app", "schema_version",
]
_SIGNALS = ["high_amount", "risky_country", "risky_category", "card_not_present", "night_txn_utc"]


def _member(name: str) -> str:
    """SQL text of one JSON member, null when the field is."""
    if name == "event_ts":
        return f"""'"{name}":"' || strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z"'"""
    if name in _TEXT_FIELDS:
        return f"""'"{name}":"' || {name} || '"'"""
    return f"""'"{name}":' || CAST({name} AS VARCHAR)"""


def _json() -> str:
    members = [_member(n) for n in _PAYLOAD_FIELDS if n not in _SIGNALS]
    nested = ", ".join(_member(n) for n in _SIGNALS)
    signals = f"""'"risk_signals":{{' || concat_ws(',', {nested}) || '}}'"""
    at = [n for n in _PAYLOAD_FIELDS if n not in _SIGNALS].index("risk_score_hint")
    return "'{' || concat_ws(',', " + ", ".join(members[:at] + [signals] + members[at:]) + ") || '}'"


# Raw rows, and clean rows before rules: a broken message has no fields.
_RAW = f"""{_SENT},
raw AS (
  SELECT *, transaction_id AS kafka_key,
    CASE WHEN copy = 3 THEN '{{"event_id": bad' ELSE {_json()} END AS raw_json
  FROM payload
)
"""
_parsed_fields = ",\n    ".join(f"CASE WHEN copy <> 3 THEN {n} END AS {n}" for n in _PAYLOAD_FIELDS)
_PARSED = f"""{_SENT},
parsed AS (
  SELECT
    {_parsed_fields},
    kafka_partition, kafka_offset, kafka_timestamp, step
  FROM payload
),
flagged AS (
  SELECT *, coalesce(amount >= 1000, FALSE) AS is_high_amount_txn,
    coalesce(country <> 'US', FALSE) AS is_cross_border
  FROM parsed
)
"""
_VALID = "event_id IS NOT NULL AND transaction_id IS NOT NULL AND amount > 0"
_FIRST = (
    "QUALIFY row_number() OVER (PARTITION BY event_id "
    "ORDER BY kafka_timestamp, kafka_partition, kafka_offset) = 1"
)
_SILVER = f"""{_PARSED},
silver AS (SELECT * FROM flagged WHERE {_VALID} {_FIRST})
"""
# The same with message coordinates and hash, where whole clean rows are compared.
_FULL = f"""{_RAW},
flagged AS (
  SELECT {", ".join(f"CASE WHEN copy <> 3 THEN {n} END AS {n}" for n in _PAYLOAD_FIELDS)},
    kafka_partition, kafka_offset, kafka_timestamp, step,
    sha256(concat_ws('||', kafka_key, raw_json)) AS bronze_record_hash,
    copy <> 3 AND amount >= 1000 AS is_high_amount_txn,
    copy <> 3 AND country <> 'US' AS is_cross_border
  FROM raw
)
"""
_CLEAN_COLUMNS = ", ".join(
    [
        *_PAYLOAD_FIELDS,
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        "bronze_record_hash",
        "is_high_amount_txn",
        "is_cross_border",
    ]
)

# Money: amounts are whole ten-thousandths, rounded half up as integers.
_UNITS = "sum(CAST(round(amount * 10000) AS BIGINT))"
_TOTAL = f"(({_UNITS} + 50) // 100) / 100.0"
_MEAN = f"((2 * {_UNITS} + 100 * count(amount)) // (200 * count(amount))) / 100.0"


def _activity(source: str) -> str:
    return f"""
  SELECT customer_id, count(*) AS transaction_count, {_TOTAL} AS total_amount,
    {_MEAN} AS avg_amount, round(max(amount), 2) AS max_amount,
    CAST(sum(CASE WHEN is_suspicious_hint THEN 1 ELSE 0 END) AS BIGINT)
      AS suspicious_transaction_count,
    count(DISTINCT country) AS countries_used,
    count(DISTINCT merchant_category) AS merchant_categories_used,
    max(event_ts) AS last_event_ts
  FROM {source} GROUP BY customer_id"""


_TARGET = f"""{_SILVER},
target AS ({_activity("(SELECT * FROM silver WHERE event_ts < TIMESTAMP '2024-01-16')")}),
newer AS (
  SELECT * FROM silver WHERE event_ts >
    (SELECT coalesce(max(last_event_ts), TIMESTAMP '1900-01-01') FROM target)
)
"""
_RECOMPUTED = f"""WITH {_TARGET},
history AS (SELECT * FROM silver WHERE customer_id IN (SELECT customer_id FROM newer)),
changes AS ({_activity("history")})
SELECT * FROM target WHERE customer_id NOT IN (SELECT customer_id FROM changes)
UNION ALL SELECT * FROM changes"""

_DEDUP_BEFORE = f"""WITH {_FULL}
SELECT {_CLEAN_COLUMNS} FROM flagged WHERE {_VALID} {_FIRST}"""
_DEDUP_AFTER = f"""WITH {_FULL},
firsts AS (SELECT * FROM flagged {_FIRST})
SELECT {_CLEAN_COLUMNS} FROM firsts WHERE {_VALID}"""


# Valid rows, and whether they are above the watermark of the deliveries before.
_IN_TIME = f"""
valid AS (SELECT * FROM flagged WHERE {_VALID}),
marks AS (SELECT step, max(event_ts) AS newest FROM valid GROUP BY step),
timed AS (
  SELECT *, coalesce(event_ts > watermark, TRUE) AS in_time FROM (
    SELECT *, (SELECT max(newest) FROM marks WHERE marks.step < valid.step)
      - INTERVAL 10 MINUTE AS watermark
    FROM valid)
)"""


_WITH_FRESH = (
    "ts AS event_ts,",
    "ts + CASE WHEN copy = 1 AND event_id % 100 = 0 THEN INTERVAL 20 DAY ELSE INTERVAL 0 DAY END"
    " AS event_ts,",
)
_IN_STEPS = "QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY step) = 1"

_CUSTOMER = f"""WITH {_SILVER}
SELECT customer_id, count(*) AS transaction_count, {_TOTAL} AS total_amount,
  {_MEAN} AS avg_amount, round(max(amount), 2) AS max_amount,
  CAST(sum(CAST(is_suspicious_hint AS INTEGER)) AS BIGINT) AS suspicious_transaction_count,
  count(country) AS country_observation_count,
  count(merchant_category) AS merchant_category_observation_count,
  max(event_ts) AS last_transaction_ts
FROM silver GROUP BY customer_id"""
_DAILY = f"""WITH {_SILVER},
days AS (
  SELECT CAST(event_ts AS DATE) AS transaction_date, count(*) AS transaction_count,
    {_TOTAL} AS total_amount, {_MEAN} AS avg_transaction_amount,
    CAST(sum(CAST(is_suspicious_hint AS INTEGER)) AS BIGINT) AS suspicious_transaction_count,
    count(customer_id) AS customer_observation_count,
    count(merchant_id) AS merchant_observation_count,
    max(event_ts) AS last_transaction_ts
  FROM silver GROUP BY 1
)
SELECT *,
  ((20000 * suspicious_transaction_count + transaction_count) // (2 * transaction_count)) / 100.0
    AS suspicious_rate_pct
FROM days"""

ORACLE: dict[str, str] = {
    "bronze_envelope": f"""WITH {_RAW}
SELECT kafka_key, raw_json, 'transactions' AS kafka_topic, kafka_partition, kafka_offset,
  kafka_timestamp, 0 AS kafka_timestamp_type,
  'azure_event_hubs_kafka' AS source_system
FROM raw""",
    "bronze_record_hash": f"""WITH {_RAW}
SELECT kafka_offset, sha256(concat_ws('||', kafka_key, raw_json)) AS bronze_record_hash FROM raw""",
    "silver_parse": f"""WITH {_FULL}
SELECT {_CLEAN_COLUMNS.replace(", is_high_amount_txn, is_cross_border", "")} FROM flagged""",
    "silver_flags": f"""WITH {_PARSED}
SELECT kafka_offset, amount, country, is_high_amount_txn, is_cross_border FROM flagged""",
    "silver_rules": f"""WITH {_PARSED}
SELECT kafka_offset, event_id, transaction_id, amount FROM flagged WHERE {_VALID}""",
    "rule_violation_counts": f"""WITH {_PARSED},
checks AS (
  SELECT event_id IS NOT NULL AS a, transaction_id IS NOT NULL AS b,
    coalesce(amount > 0, FALSE) AS c
  FROM parsed
)
SELECT 'valid_event_id' AS rule, count(*) FILTER (a) AS passed, count(*) FILTER (NOT a) AS failed
FROM checks
UNION ALL SELECT 'valid_transaction_id', count(*) FILTER (b), count(*) FILTER (NOT b) FROM checks
UNION ALL SELECT 'valid_amount', count(*) FILTER (c), count(*) FILTER (NOT c) FROM checks""",
    "silver_dedup_before": _DEDUP_BEFORE,
    "silver_dedup_after": _DEDUP_AFTER,
    "silver_stream": _DEDUP_BEFORE,
    "silver_stream_after": _DEDUP_AFTER,
    "silver_stream_within_watermark": _DEDUP_BEFORE,
    "silver_stream_batches": f"""WITH {_FULL.replace(*_WITH_FRESH)}, {_IN_TIME}
SELECT {_CLEAN_COLUMNS} FROM timed WHERE in_time {_IN_STEPS}""",
    "silver_stream_batches_within": f"""WITH {_FULL.replace(*_WITH_FRESH)}, {_IN_TIME}
SELECT {_CLEAN_COLUMNS} FROM timed WHERE in_time QUALIFY coalesce(
  lag(event_ts) OVER (PARTITION BY event_id ORDER BY step) + INTERVAL 10 MINUTE <= watermark, TRUE)
""",
    "late_rows_dropped": f"""WITH {_PARSED.replace(*_WITH_FRESH)}, {_IN_TIME}
SELECT CAST(range AS INTEGER) AS step, count(event_id) AS late_rows
FROM range(4) LEFT JOIN (SELECT * FROM timed WHERE NOT in_time) ON step = range
GROUP BY 1""",
    "customer_risk_summary": _CUSTOMER,
    "merchant_risk_summary": f"""WITH {_SILVER}
SELECT merchant_id, merchant_name, merchant_category, count(*) AS transaction_count,
  {_TOTAL} AS total_amount, {_MEAN} AS avg_amount,
  CAST(sum(CAST(is_suspicious_hint AS INTEGER)) AS BIGINT) AS suspicious_transaction_count,
  count(customer_id) AS customer_observation_count,
  count(country) AS country_observation_count,
  max(event_ts) AS last_transaction_ts
FROM silver GROUP BY merchant_id, merchant_name, merchant_category""",
    "daily_kpis": _DAILY,
    "customer_risk_distinct": f"WITH {_SILVER} {_activity('silver')}",
    "incremental_fold": f"WITH {_SILVER} {_activity('silver')}",
    "suspicious_null_semantics": f"""WITH {_SILVER},
hinted AS (
  SELECT customer_id, CASE WHEN customer_id % 10 <> 0 THEN is_suspicious_hint END AS hint
  FROM silver
)
SELECT customer_id, count(*) AS transaction_count,
  CAST(sum(CAST(hint AS INTEGER)) AS BIGINT) AS count_or_null,
  CAST(sum(CASE WHEN hint THEN 1 ELSE 0 END) AS BIGINT) AS count_or_zero
FROM hinted GROUP BY customer_id""",
    "aggregate_functions": f"""WITH {_SILVER}
SELECT channel, count(*) AS row_count, count(device_id) AS device_count,
  count(DISTINCT country) AS distinct_countries, {_TOTAL} AS total_amount,
  {_MEAN} AS avg_amount, round(max(amount), 2) AS max_amount, max(event_ts) AS last_event_ts,
  CAST(sum(CAST(is_suspicious_hint AS INTEGER)) AS BIGINT) AS suspicious_or_null,
  CAST(sum(CASE WHEN is_suspicious_hint THEN 1 ELSE 0 END) AS BIGINT) AS suspicious
FROM silver GROUP BY channel""",
    "risk_signals": f"""WITH {_SENT}
SELECT kafka_offset AS "offset", {", ".join(_SIGNALS)} FROM signals""",
    "risk_scores": f"""WITH {_SENT}
SELECT kafka_offset AS "offset", risk_score_hint, is_suspicious_hint FROM payload""",
    "channel_nulling": f"""WITH {_SENT}
SELECT kafka_offset AS "offset", channel, device_id, ip_address FROM fields""",
    "message_round_trip": f"""WITH {_SENT}
SELECT {", ".join(_PAYLOAD_FIELDS)}, transaction_id AS kafka_key FROM payload""",
    "incremental_replace": f"""WITH {_TARGET},
changes AS ({_activity("newer")})
SELECT * FROM target WHERE customer_id NOT IN (SELECT customer_id FROM changes)
UNION ALL SELECT * FROM changes""",
    "incremental_recompute": _RECOMPUTED,
    "incremental_apply": _RECOMPUTED,
    "high_water_filter": f"""WITH {_TARGET}
SELECT event_id, customer_id, amount, event_ts FROM newer""",
    "export_batches": _DEDUP_BEFORE,
    "export_appended": _DEDUP_BEFORE,
    "gold_kept_fresh": _DAILY,
    "view_refresh": _CUSTOMER,
    "gold_catch_up": _DAILY,
}
# The same results by other ways: kept by cells, or in buckets.
ORACLE |= {
    "gold_by_cells": ORACLE["daily_kpis"],
    "merchants_by_cells": ORACLE["merchant_risk_summary"],
    "customers_by_cells": ORACLE["customer_risk_summary"],
    "activity_by_cells": ORACLE["customer_risk_distinct"],
    "activity_in_buckets": ORACLE["customer_risk_distinct"],
    "activity_by_bitmaps": ORACLE["customer_risk_distinct"],
}
# By further ways: touched days, exactly-once export, noted counts, two memories of ids.
ORACLE |= {
    "gold_by_touched_days": ORACLE["daily_kpis"],
    "export_once": ORACLE["export_batches"],
    "silver_in_sized_files": ORACLE["export_batches"],
    "rule_ledger": ORACLE["rule_violation_counts"],
    "silver_stream_in_tiers": ORACLE["silver_stream_batches"],
    "stream_state_audit": f"""WITH {_PARSED.replace(*_WITH_FRESH)}, {_IN_TIME}
SELECT CAST(range AS INTEGER) AS step, event_id
FROM range(4) JOIN (SELECT event_id, min(step) AS first FROM timed WHERE in_time GROUP BY event_id)
  ON first <= range""",
}
