"""Results between the steps of a job, and texts on the move."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from txrisk.llm import text as tx
from txrisk.session import scratch_path

PACKED_DDL = "doc_id long, packed binary, size long"


def spare_name(name: str, columns: list[str]) -> str:
    """The name, with ``_`` added while one of the columns has it."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read again: computed once, and
    there for later steps even if executors are lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(df: DataFrame) -> None:
    """Let the files of finished shuffles go now. Spark deletes them once the driver's
    memory of them is collected, which a driver with little to do puts off for long."""
    df.sparkSession.sparkContext._jvm.System.gc()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, raw, offsets in tx.pieces(batches):
        data = raw.tobytes()
        rows = [
            pa.compress(data[a:b], codec="zstd", asbytes=True) if b > a else b""
            for a, b in zip(offsets, offsets[1:], strict=False)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(rows, pa.binary()), pa.array(np.diff(offsets))],
            names=["doc_id", "packed", "size"],
        )


def packed(documents: DataFrame) -> DataFrame:
    """``doc_id, packed, size``: texts compressed (null as empty), to be moved."""
    return documents.select("doc_id", "text").mapInArrow(_packed, PACKED_DDL)


def unpacked(row: bytes, size: int) -> np.ndarray:
    """The bytes of a packed text."""
    if not size:
        return np.zeros(0, np.uint8)
    return np.frombuffer(pa.decompress(row, size, codec="zstd", asbytes=True), np.uint8)
