"""Column contracts of the message, raw (bronze) and clean (silver) layers."""

from __future__ import annotations

# --- Fixed values: names and types that messages and tables must have ---------

# What a message source delivers (the public Kafka source columns).
ENVELOPE_DDL = """
    key binary, value binary, topic string, partition int, offset bigint,
    timestamp timestamp, timestampType int
"""

# The JSON document inside ``value``. Every field may be null.
PAYLOAD_DDL = """
    event_id string, transaction_id string, customer_id bigint, card_id bigint,
    merchant_id bigint, merchant_name string, merchant_category string,
    amount double, currency string, country string, city string, channel string,
    device_id string, ip_address string, event_ts string,
    risk_signals map<string, boolean>, risk_score_hint bigint,
    is_suspicious_hint boolean, producer_app string, schema_version string
"""

# Lineage columns a clean row keeps from its raw row.
CARRIED = [
    "kafka_partition",
    "kafka_offset",
    "kafka_timestamp",
    "bronze_ingestion_ts",
    "bronze_record_hash",
]

SOURCE_SYSTEM = "azure_event_hubs_kafka"
HASH_SEPARATOR = "||"

WATERMARK_DELAY = "10 minutes"
INGEST_INTERVAL = "10 seconds"
CLEAN_INTERVAL = "10 seconds"
EXPORT_INTERVAL = "30 seconds"

# --- End of fixed values ------------------------------------------------------
