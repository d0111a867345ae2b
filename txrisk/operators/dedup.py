"""De-duplication: one row per event id, the first to arrive."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txrisk.schema import WATERMARK_DELAY

Retention = Literal["forever", "within_watermark"]


def first_arrivals(
    df: DataFrame,
    key: str = "event_id",
    arrival: tuple[str, ...] = ("kafka_timestamp", "kafka_partition", "kafka_offset"),
) -> DataFrame:
    """Batch form. A null key is a key like any other.

    Offsets count within a partition, so that across partitions only the broker's
    time tells which copy came first.

    Spark turns "row_number = 1" into a per-task limit ahead of the shuffle, so
    a task passes on at most one row per key: an id that holds a third of the
    table reaches its reducer as one row per map task.
    """
    order = Window.partitionBy(key).orderBy(*arrival)
    return (
        df.withColumn("_nth", F.row_number().over(order))
        .filter(F.col("_nth") == 1)
        .drop("_nth")
    )


def first_arrivals_stream(
    df: DataFrame,
    key: str = "event_id",
    event_time: str = "event_ts",
    delay: str = WATERMARK_DELAY,
    retention: Retention = "forever",
) -> DataFrame:
    """Stream form, under an event-time watermark.

    ``forever``: an id seen once never passes again, so state only grows. Rows no
    newer than the watermark are dropped. ``within_watermark``: an id is
    forgotten one delay after its event time, and may then pass again.

    Every copy goes to the reducer that owns its id and costs one look-up there; a
    flood of copies of one id is that one reducer's work, and adds no state.
    """
    if retention not in ("forever", "within_watermark"):
        raise ValueError(f"retention must be forever or within_watermark, not {retention!r}")
    rows = df.withWatermark(event_time, delay)
    if retention == "within_watermark":
        return rows.dropDuplicatesWithinWatermark([key])
    return rows.dropDuplicates([key])
