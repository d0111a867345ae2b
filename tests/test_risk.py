"""Risk rules over single transactions, and message encoding."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from txrisk.functions.risk import is_suspicious, only_remote, risk_score, risk_signals
from txrisk.sources.messages import encode_messages

COLUMNS = "amount double, country string, merchant_category string, channel string, event_ts timestamp_ntz"


def _scored(spark, rows):
    from datetime import datetime

    rows = [(*r[:4], datetime.fromisoformat(r[4]) if r[4] else None) for r in rows]
    df = spark.createDataFrame(rows, COLUMNS).withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    return df.withColumn("risk_signals", risk_signals()).withColumn("score", risk_score()).withColumn(
        "suspicious", is_suspicious("score")
    )


def test_each_signal(spark):
    quiet = (749.99, "US", "grocery", "pos", "2024-01-01T05:00:00")
    loud = (750.0, "NG", "luxury", "ecommerce", "2024-01-01T04:59:59")
    rows = [quiet, loud] + [quiet[:i] + loud[i : i + 1] + quiet[i + 1 :] for i in range(5)]
    got = _scored(spark, rows).collect()
    assert [r.score for r in got] == [0, 5, 1, 1, 1, 1, 1]
    assert set(got[0].risk_signals) == {
        "high_amount", "risky_country", "risky_category", "card_not_present", "night_txn_utc",
    }
    assert [r.suspicious for r in got] == [False, True, False, False, False, False, False]


def test_two_signals_are_suspicious_and_nulls_are_quiet(spark):
    two, none = _scored(
        spark, [(800.0, "BR", "fuel", "pos", "2024-01-01T12:00:00"), (None, None, None, None, None)]
    ).collect()
    assert (two.score, two.suspicious) == (2, True)
    assert set(none.risk_signals.values()) == {False}
    assert (none.score, none.suspicious) == (0, False)


def test_only_remote(spark):
    df = spark.createDataFrame([("ecommerce", "d"), ("pos", "d"), (None, "d")], "channel string, device_id string")
    assert [r[0] for r in df.select(only_remote("device_id")).collect()] == ["d", None, None]


def test_encoded_message_keeps_microseconds_and_leaves_nulls_out(spark):
    df = spark.sql(
        "SELECT 't1' AS transaction_id, 12.5D AS amount, CAST(NULL AS STRING) AS device_id, "
        "TIMESTAMP '2024-01-01 00:00:00.123456' AS event_ts, map('x', true) AS risk_signals"
    )
    row = encode_messages(df).first()
    assert bytes(row.key) == b"t1"
    assert json.loads(bytes(row.value)) == {
        "transaction_id": "t1",
        "amount": 12.5,
        "event_ts": "2024-01-01T00:00:00.123456Z",
        "risk_signals": {"x": True},
    }
