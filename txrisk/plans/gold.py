"""Risk summaries over the clean transaction table.

Each is one grouping. Every measure but the distinct counts adds up in
fixed-width buffers, so Spark combines rows inside each task before the shuffle
and a key that holds a third of the table costs its reducer one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.functions import measures as m
from txrisk.functions.scalars import percentage


def summarise(df: DataFrame, keys: list[str | Column], measures: dict[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[col.alias(name) for name, col in measures.items()])


def customer_risk_summary(silver: DataFrame) -> DataFrame:
    """Per customer. ``…_observation_count`` counts occurrences, not distinct values."""
    return summarise(
        silver,
        ["customer_id"],
        {
            "transaction_count": m.rows(),
            "total_amount": m.total("amount"),
            "avg_amount": m.mean("amount"),
            "max_amount": m.peak("amount"),
            "suspicious_transaction_count": m.flagged_or_null("is_suspicious_hint"),
            "country_observation_count": m.given("country"),
            "merchant_category_observation_count": m.given("merchant_category"),
            "last_transaction_ts": m.latest("event_ts"),
        },
    )


def merchant_risk_summary(silver: DataFrame) -> DataFrame:
    """Per merchant id, name and category together: one id may carry many names."""
    return summarise(
        silver,
        ["merchant_id", "merchant_name", "merchant_category"],
        {
            "transaction_count": m.rows(),
            "total_amount": m.total("amount"),
            "avg_amount": m.mean("amount"),
            "suspicious_transaction_count": m.flagged_or_null("is_suspicious_hint"),
            "customer_observation_count": m.given("customer_id"),
            "country_observation_count": m.given("country"),
            "last_transaction_ts": m.latest("event_ts"),
        },
    )


def daily_kpis(silver: DataFrame) -> DataFrame:
    """Per UTC day of event time, with the share of suspicious transactions."""
    per_day = summarise(
        silver,
        [F.to_date("event_ts").alias("transaction_date")],
        {
            "transaction_count": m.rows(),
            "total_amount": m.total("amount"),
            "avg_transaction_amount": m.mean("amount"),
            "suspicious_transaction_count": m.flagged_or_null("is_suspicious_hint"),
            "customer_observation_count": m.given("customer_id"),
            "merchant_observation_count": m.given("merchant_id"),
            "last_transaction_ts": m.latest("event_ts"),
        },
    )
    share = percentage(F.col("suspicious_transaction_count"), F.col("transaction_count"))
    return per_day.withColumn("suspicious_rate_pct", share)
