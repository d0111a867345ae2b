"""Risk rules over one transaction, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txrisk.functions.scalars import holds

# --- Fixed values: the rules' thresholds and lists ----------------------------
# Note that a risky amount starts lower than the "high amount" flag of the clean
# layer (1000); both are wanted.
RISKY_AMOUNT_FROM = 750
RISKY_COUNTRIES = ["NG", "BR", "AE"]
RISKY_CATEGORIES = ["cash_advance", "gaming", "luxury"]
REMOTE_CHANNEL = "ecommerce"
NIGHT_HOURS_UTC = [0, 1, 2, 3, 4]
SUSPICIOUS_FROM_SCORE = 2
# ------------------------------------------------------------------------------


def signal_columns() -> dict[str, Column]:
    """The five signals by name. A null input leaves its signal off."""
    rules = {
        "high_amount": F.col("amount") >= RISKY_AMOUNT_FROM,
        "risky_country": F.col("country").isin(RISKY_COUNTRIES),
        "risky_category": F.col("merchant_category").isin(RISKY_CATEGORIES),
        "card_not_present": F.col("channel") == REMOTE_CHANNEL,
        "night_txn_utc": F.hour("event_ts").isin(NIGHT_HOURS_UTC),
    }
    return {name: holds(rule) for name, rule in rules.items()}


def risk_signals() -> Column:
    """The signals as one map<string, boolean>."""
    pairs = [x for name, on in signal_columns().items() for x in (F.lit(name), on)]
    return F.create_map(*pairs)


def risk_score(signals: str | Column = "risk_signals") -> Column:
    """How many signals in the map are on."""
    return F.size(F.map_filter(signals, lambda _, on: on)).cast("bigint")


def is_suspicious(score: str | Column = "risk_score_hint") -> Column:
    score = F.col(score) if isinstance(score, str) else score
    return score >= SUSPICIOUS_FROM_SCORE


def only_remote(column: str) -> Column:
    """The column on remote transactions, null on every other channel."""
    return F.when(F.col("channel") == REMOTE_CHANNEL, F.col(column))
