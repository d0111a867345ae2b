"""The clean transaction table."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame

from txrisk.operators.dedup import Retention, first_arrivals, first_arrivals_stream
from txrisk.operators.parse import to_typed
from txrisk.operators.rules import SILVER_RULES, expect_or_drop, watch_rules
from txrisk.schema import WATERMARK_DELAY

Placement = Literal["before_dedup", "after_dedup"]


def _one_per_event(df: DataFrame, delay: str, retention: Retention) -> DataFrame:
    if not df.isStreaming:
        return first_arrivals(df)
    return first_arrivals_stream(df, delay=delay, retention=retention)


def clean(
    bronze: DataFrame,
    rules_at: Placement = "before_dedup",
    delay: str = WATERMARK_DELAY,
    retention: Retention = "forever",
    rules: dict[str, str] = SILVER_RULES,
    watch: str | None = None,
) -> DataFrame:
    """Raw rows, batch or stream, to typed, flagged, valid, unique transactions.

    Where the rules sit changes the result. Before de-duplication an invalid copy
    never counts, so a later valid copy of the same event is kept. After it, the
    invalid first copy takes the event's place and is then dropped: the event is
    lost, and invalid rows move the watermark too.

    ``watch`` names an observation of the rows the rules see and how many fail
    each, reported with every micro-batch.
    """

    def valid(df: DataFrame) -> DataFrame:
        return expect_or_drop(watch_rules(df, watch, rules) if watch else df, rules)

    def unique(df: DataFrame) -> DataFrame:
        return _one_per_event(df, delay, retention)

    typed = to_typed(bronze)
    if rules_at == "before_dedup":
        return unique(valid(typed))
    if rules_at == "after_dedup":
        return valid(unique(typed))
    raise ValueError(f"rules_at must be before_dedup or after_dedup, not {rules_at!r}")
