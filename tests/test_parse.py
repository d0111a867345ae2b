"""JSON text to typed columns, and what faulty text turns into."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from txrisk.functions.scalars import iso_timestamp
from txrisk.operators.parse import parse_payload, to_typed
from txrisk.operators.rules import expect_or_drop

DDL = (
    "event_id string, customer_id bigint, amount double, event_ts string, "
    "risk_signals map<string, boolean>, ok boolean"
)
NOTHING = (None, None, None, None, None)
CASES = [
    ("{bad", NOTHING),
    ("[]", NOTHING),
    ("null", NOTHING),
    ('[{"event_id":"x"},{"event_id":"y"}]', NOTHING),
    ("", NOTHING),
    (None, NOTHING),
    ('{"event_id":"b","customer_id":1.5,"amount":"12.5"}', ("b", None, None, None, None)),
    ('{"event_id":7,"amount":-1,"ok":"true"}', ("7", None, -1.0, None, None)),
    (
        '{"event_id":"d","customer_id":"12","amount":1e3,"risk_signals":{"x":"true"}}',
        ("d", None, 1000.0, None, None),
    ),
    ('{"event_id":"dup","event_id":"dup2"}', ("dup2", None, None, None, None)),
    ('{"event_id":{"z":1},"amount":2}', ('{"z":1}', None, 2.0, None, None)),
    ('{"EVENT_ID":"case","amount":2}', (None, None, 2.0, None, None)),
    ('{"event_id":"e","amount":2} trailing', ("e", None, 2.0, None, None)),
    ('{"event_id":"f","unknown":[1]}', ("f", None, None, None, None)),
    ('{"risk_signals":{"x":true},"ok":false}', (None, None, None, {"x": True}, False)),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_json_cases(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, raw_json string")
        rows = parse_payload(df, DDL, ["i"]).orderBy("i").collect()
        got = [(r.event_id, r.customer_id, r.amount, r.risk_signals, r.ok) for r in rows]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert got == [c[1] for c in CASES]


def test_nan_amount_is_read_and_passes_the_rules(spark):
    df = spark.createDataFrame([('{"event_id":"c","amount":NaN}',)], "raw_json string")
    (row,) = expect_or_drop(parse_payload(df, DDL, []), {"amount": "amount > 0"}).collect()
    assert math.isnan(row.amount)


def test_timestamps(spark):
    text = ["2024-01-01T10:00:00+02:00", "2024-01-01T10:00:00.123456Z", "2024-01-02", "junk", "", None]
    df = spark.createDataFrame([(t,) for t in text], "t string")
    got = [r[0] for r in df.select(iso_timestamp("t").cast("string")).collect()]
    assert got == [
        "2024-01-01 08:00:00",
        "2024-01-01 10:00:00.123456",
        "2024-01-02 00:00:00",
        None,
        None,
        None,
    ]


def test_flags_are_never_null(spark):
    text = [
        '{"amount":1000,"country":"US"}',
        '{"amount":999.99,"country":"us"}',
        '{"amount":NaN}',
        "{}",
    ]
    bronze = spark.createDataFrame([(i, t) for i, t in enumerate(text)], "kafka_offset bigint, raw_json string")
    bronze = bronze.withColumns(
        {
            "kafka_partition": F.lit(0),
            "kafka_timestamp": F.current_timestamp(),
            "bronze_ingestion_ts": F.current_timestamp(),
            "bronze_record_hash": F.lit(""),
        }
    )
    typed = to_typed(bronze)
    assert len(typed.columns) == 28
    assert dict(typed.dtypes)["event_ts"] == "timestamp"
    assert typed.columns.index("event_ts") == 14
    rows = typed.orderBy("kafka_offset").collect()
    assert [(r.is_high_amount_txn, r.is_cross_border) for r in rows] == [
        (True, False), (False, True), (True, False), (False, False),
    ]
