"""Named rules: dropping, counting, watching."""

from __future__ import annotations

from pyspark.sql import Observation

from txrisk.operators.rules import SILVER_RULES, expect_or_drop, rule_counts, watch_rules

ROWS = [
    ("e", "t", 1.0),
    (None, "t", 1.0),
    ("e", None, 1.0),
    ("e", "t", 0.0),
    ("e", "t", None),
    ("e", "t", float("nan")),
    (None, None, -1.0),
]


def _rows(spark):
    return spark.createDataFrame(ROWS, "event_id string, transaction_id string, amount double")


def test_unknown_is_a_failure_and_nan_passes(spark):
    assert expect_or_drop(_rows(spark)).count() == 2


def test_no_rules_keep_everything(spark):
    assert expect_or_drop(_rows(spark), {}).count() == len(ROWS)


def test_counts(spark):
    got = {r.rule: (r.passed, r.failed) for r in rule_counts(_rows(spark)).collect()}
    assert got == {"valid_event_id": (5, 2), "valid_transaction_id": (5, 2), "valid_amount": (4, 3)}


def test_watching_a_batch(spark):
    seen = Observation("rules")
    df = watch_rules(_rows(spark), seen)
    assert df.count() == len(ROWS)
    assert seen.get == {"rows": 7, "valid_event_id": 2, "valid_transaction_id": 2, "valid_amount": 3}


def test_watching_a_stream(spark, play):
    batches = [_rows(spark).limit(3), _rows(spark)]
    _, progress = play(batches, lambda s: expect_or_drop(watch_rules(s, "quality")))
    seen = [p["observedMetrics"]["quality"] for p in progress]
    assert [(s["rows"], s["valid_event_id"], s["valid_amount"]) for s in seen] == [(3, 1, 0), (7, 2, 3)]


def test_rule_names():
    assert list(SILVER_RULES) == ["valid_event_id", "valid_transaction_id", "valid_amount"]
