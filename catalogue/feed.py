"""The ``events`` table as a feed of keyed transaction messages.

Stands in for a broker: each event becomes one message, and some events are sent
again (unchanged, corrected, or as broken text), so that the feed holds the
duplicates and faults a real one has. It never leaves an event out. Works on
``events`` as a batch or a stream; map-only.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.operators.score import hide_unless_remote, score
from txrisk.session import pin_utc
from txrisk.sources.messages import as_json

EVENTS_DDL = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)

# --- Fixed values of the feed -------------------------------------------------
CATEGORIES = [
    "grocery",
    "fuel",
    "restaurant",
    "travel",
    "electronics",
    "gaming",
    "cash_advance",
    "luxury",
    "subscription",
]
COUNTRIES = ["US", "GB", "SE", "DE", "IN", "NG", "BR", "AE", "US", "US"]
CHANNELS = {
    "view": "pos",
    "error": "pos",
    "signup": "atm",
    "click": "ecommerce",
    "purchase": "ecommerce",
}
FIRST, REDELIVERED, CORRECTED, BROKEN = 0, 1, 2, 3
PARTITIONS = 4
OFFSET_STEP = 1_000_000_000  # a later copy has the smaller offset, in another partition
LATER = "1 minute"  # of each further copy at the broker
ENVELOPE = ["copy", "partition", "offset", "sent_at", "step"]
SECOND_HALF = "2024-01-16"
STEPS = 4
FRESH = "20 days"
BROKEN_TEXT = '{"event_id": bad'
# ------------------------------------------------------------------------------


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pin_utc(spark).read.schema(EVENTS_DDL).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    reader = pin_utc(spark).readStream.schema(EVENTS_DDL)
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def _dealt(copies: DataFrame) -> DataFrame:
    """By event id, as a broker deals keyed messages over its partitions, and over as many
    as the session shuffles into, at every size: without a number adaptive execution would
    merge a small table's to one, and one core would write and parse all messages."""
    number = int(copies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return copies.repartition(number, "event_id")


def _sql_list(values: Iterable[object]) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


# One message per copy, null for none; an event's own first message is always among them.
# The nulls are filtered out behind, which stays in generated code with all that follows.
_COPIES = f"""explode(array(
    {FIRST},
    if(event_id % 50 = 0, {REDELIVERED}, NULL),
    if(event_id % 97 = 0 AND event_id % 50 <> 0, {CORRECTED}, NULL),
    if(event_id % 200 = 7, {BROKEN}, NULL)
)) AS copy"""

_TRANSACTION = f"""
    CAST(event_id AS STRING) AS event_id;
    CASE WHEN event_id % 101 <> 0 THEN concat('txn-', event_id) END AS transaction_id;
    user_id AS customer_id;
    user_id * 10 + event_id % 3 AS card_id;
    k AS merchant_id;
    concat('Merchant#', k) AS merchant_name;
    element_at(array({_sql_list(CATEGORIES)}), CAST(k % 9 AS INT) + 1) AS merchant_category;
    CASE WHEN event_id % 97 = 0 AND copy <> {CORRECTED} THEN -1 ELSE 1 END * round(value * 10, 2)
      AS amount;
    'USD' AS currency;
    element_at(array({_sql_list(COUNTRIES)}), CAST((event_id * 7 + user_id) % 10 AS INT) + 1)
      AS country;
    concat('City#', user_id % 20) AS city;
    map({_sql_list(x for pair in CHANNELS.items() for x in pair)})[event_type] AS channel;
    concat('dev-', event_id) AS device_id;
    '10.0.0.1' AS ip_address;
    CAST(ts AS TIMESTAMP) AS event_ts;
    copy;
    CAST((event_id + copy) % {PARTITIONS} AS INT) AS partition;
    event_id DIV {PARTITIONS} + CAST({BROKEN} - copy AS BIGINT) * {OFFSET_STEP} AS offset;
    CAST(ts AS TIMESTAMP) + copy * INTERVAL {LATER} AS sent_at;
    CAST(if(ts < '{SECOND_HALF}', 0, 1)
      + CASE copy WHEN {REDELIVERED} THEN 1 WHEN {CORRECTED} THEN 1 + event_id % 2 ELSE 0 END
      AS INT) AS step
"""


def transactions(events: DataFrame) -> DataFrame:
    """One transaction per message, with ``event_ts`` still a timestamp and a
    ``copy`` column telling which message of its event it is.

    Copies are dealt, and ``props`` read, behind their making: a filter on them or on their
    delivery passes below, and only messages that are wanted are moved and made."""
    copies = _dealt(events.selectExpr("*", _COPIES).filter("copy IS NOT NULL"))
    keyed = copies.selectExpr("*", "CAST(get_json_object(props, '$.k') AS BIGINT) AS k")
    plain = keyed.selectExpr(*_TRANSACTION.split(";"))
    return hide_unless_remote(plain, "device_id", "ip_address")


def payload(events: DataFrame) -> DataFrame:
    """The transactions with every payload field, plus those of :data:`ENVELOPE`."""
    return score(transactions(events)).withColumns(
        {"producer_app": F.lit("fixture"), "schema_version": F.lit("1.0")}
    )


def messages(events: DataFrame) -> DataFrame:
    """Message envelopes as a broker source would deliver them."""
    return _envelopes(payload(events)).drop("step")


def messages_in_steps(events: DataFrame) -> DataFrame:
    """The envelopes and in which of :data:`STEPS` deliveries each comes: events by
    half of the month, and their copies one or two deliveries later. Some
    redelivered ones bear a later event time, and so come in time."""
    sent = payload(events)
    fresh = (F.col("copy") == REDELIVERED) & (F.col("event_id").cast("bigint") % 100 == 0)
    later = F.when(fresh, F.expr(f"event_ts + INTERVAL {FRESH}")).otherwise(F.col("event_ts"))
    return _envelopes(sent.withColumn("event_ts", later))


def _envelopes(sent: DataFrame) -> DataFrame:
    document = as_json(*[c for c in sent.columns if c not in ENVELOPE])
    text = F.when(F.col("copy") == BROKEN, BROKEN_TEXT).otherwise(document)
    return sent.select(
        F.col("transaction_id").cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.lit("transactions").alias("topic"),
        "partition",
        "offset",
        F.col("sent_at").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        "step",
    )
