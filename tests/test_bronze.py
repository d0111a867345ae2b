"""Raw capture: envelope projection and the record hash."""

from __future__ import annotations

import hashlib

from txrisk.functions.scalars import record_hash
from txrisk.operators.bronze import to_bronze
from txrisk.schema import ENVELOPE_DDL
from txrisk.sources.kafka import broker_options, message_options


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_hash_skips_nulls_and_is_not_injective(spark):
    df = spark.createDataFrame(
        [("k", "v"), (None, "v"), ("k", None), (None, None), ("a", "b"), (None, "a||b")],
        "key string, value string",
    )
    got = [r[0] for r in df.select(record_hash("key", "value")).collect()]
    assert got == [sha("k||v"), sha("v"), sha("k"), sha(""), sha("a||b"), sha("a||b")]


def test_envelope(spark):
    from datetime import datetime

    at = datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [(bytearray("ключ".encode()), bytearray(b"{}"), "t", 3, 7, at, 0), (None, None, "t", 3, 8, at, 1)],
        ENVELOPE_DDL,
    )
    bronze = to_bronze(df, "here")
    assert bronze.dtypes == [
        ("kafka_key", "string"),
        ("raw_json", "string"),
        ("kafka_topic", "string"),
        ("kafka_partition", "int"),
        ("kafka_offset", "bigint"),
        ("kafka_timestamp", "timestamp"),
        ("kafka_timestamp_type", "int"),
        ("source_system", "string"),
        ("bronze_ingestion_ts", "timestamp"),
        ("bronze_record_hash", "string"),
    ]
    first, second = bronze.orderBy("kafka_offset").collect()
    assert (first.kafka_key, first.raw_json, first.source_system) == ("ключ", "{}", "here")
    assert first.bronze_record_hash == sha("ключ||{}")
    assert second.bronze_record_hash == sha("")


def test_message_options():
    options = message_options("h:9093", "tx", "group", "login", maxOffsetsPerTrigger="1000")
    assert options == {
        "kafka.bootstrap.servers": "h:9093",
        "subscribe": "tx",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "kafka.group.id": "group",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": "login",
        "maxOffsetsPerTrigger": "1000",
    }
    assert "kafka.security.protocol" not in message_options("h:9092", "tx")
    assert broker_options("h:9092") == {"kafka.bootstrap.servers": "h:9092"}
