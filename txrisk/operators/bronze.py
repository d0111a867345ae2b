"""Message envelope to raw (bronze) row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions.scalars import record_hash
from txrisk.schema import SOURCE_SYSTEM

# Raw column <- envelope column, and its cast where it changes type.
_RENAMED = {
    "kafka_key": ("key", "string"),
    "raw_json": ("value", "string"),
    "kafka_topic": ("topic", None),
    "kafka_partition": ("partition", None),
    "kafka_offset": ("offset", None),
    "kafka_timestamp": ("timestamp", None),
    "kafka_timestamp_type": ("timestampType", None),
}


def to_bronze(messages: DataFrame, source_system: str = SOURCE_SYSTEM) -> DataFrame:
    """Keep the whole message as text, its coordinates, and how it got here.

    A map-only step: no shuffle, whatever the size or skew of the input.
    """
    raw = messages.select(
        *[
            (F.col(src).cast(to) if to else F.col(src)).alias(name)
            for name, (src, to) in _RENAMED.items()
        ]
    )
    return raw.withColumns(
        {
            "source_system": F.lit(source_system),
            "bronze_ingestion_ts": F.current_timestamp(),
            "bronze_record_hash": record_hash("kafka_key", "raw_json"),
        }
    )
