"""Rows to keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# By default Spark writes timestamps into JSON with their microseconds cut off.
_KEEP_MICROSECONDS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def as_json(*columns: str | Column) -> Column:
    """The columns as one JSON document, null fields left out."""
    return F.to_json(F.struct(*columns), _KEEP_MICROSECONDS)


def encode_messages(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """``key`` and ``value`` binaries, ready for ``write.format("kafka")`` or files."""
    return df.select(
        F.col(key).cast("binary").alias("key"),
        as_json(*df.columns).cast("binary").alias("value"),
    )
