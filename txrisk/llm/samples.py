"""Bounded samples of labelled rows, to fit models on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(column: str, modulus: int) -> Column:
    """crc32 of a number written as text, modulo ``modulus``; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def labelled(labels: DataFrame, label: str, limit: int, usable: Column | None = None) -> DataFrame:
    """At most ``limit`` rows ``doc_id, label``, those of lowest hash: a sample that
    does not depend on order or partitions. Of several labels of one document the
    largest counts; null ids and labels are left out."""
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if usable is not None:
        rows = rows.filter(usable)
    one = rows.groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def documents_of(documents: DataFrame, sample: DataFrame) -> DataFrame:
    """``doc_id, text, label`` of a bounded sample's documents. The sample, being
    bounded by its limit, is sent to where the texts are."""
    return documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
