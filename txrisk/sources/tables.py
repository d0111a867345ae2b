"""Tables and envelope files as batches or streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txrisk.schema import ENVELOPE_DDL


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_stream_table(spark: SparkSession, name: str, **options: str) -> DataFrame:
    """The table's rows as a stream, those it holds now first.

    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bound each micro-batch.
    """
    return spark.readStream.options(**options).table(name)


def read_envelope_files(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Stream of message envelopes landed as parquet, for sites without a broker."""
    return spark.readStream.schema(ENVELOPE_DDL).options(**options).parquet(path)
