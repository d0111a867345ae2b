"""Append a stream to a table, or hand it on one micro-batch at a time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from txrisk.schema import EXPORT_INTERVAL, INGEST_INTERVAL

WriteBatch = Callable[[DataFrame, int], None]


def _appending(df: DataFrame, checkpoint: str, interval: str | None) -> DataStreamWriter:
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if interval is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)


def write_stream_table(
    df: DataFrame,
    table: str,
    checkpoint: str,
    interval: str | None = INGEST_INTERVAL,
    path: str | None = None,
    format: str = "parquet",
    partition_by: list[str] | None = None,
) -> StreamingQuery:
    """Append the stream to a table, each row exactly once.

    Without an interval the query takes what there is now and ends. ``path``
    keeps the table's files outside the warehouse. A restart goes on from the
    checkpoint, which belongs to this one stream and must be on shared storage.
    """
    writer = _appending(df, checkpoint, interval).format(format)
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.toTable(table)


def export_stream(
    df: DataFrame,
    write_batch: WriteBatch,
    checkpoint: str,
    interval: str | None = EXPORT_INTERVAL,
) -> StreamingQuery:
    """Call ``write_batch(rows, batch_id)`` for every micro-batch that has rows.

    A batch whose call failed half-way is handed over again under the same id,
    so delivery is at least once unless the writer uses the id to replace. The rows
    are planned twice, to see whether there are any and to write them: hand over a
    table's rows, not those of a stateful query, whose state would be run twice.
    """

    def hand_over(rows: DataFrame, batch_id: int) -> None:
        if not rows.isEmpty():
            write_batch(rows, batch_id)

    return _appending(df, checkpoint, interval).foreachBatch(hand_over).start()


def append_to(format: str, **options: str) -> WriteBatch:
    """Writer for an outside table through any batch connector (``jdbc``, a
    warehouse connector, ...), with whatever options that connector takes."""

    def write(rows: DataFrame, _batch_id: int) -> None:
        rows.write.format(format).options(**options).mode("append").save()

    return write


def replace_batch_in(path: str, format: str = "parquet") -> WriteBatch:
    """Writer of one ``batch_id=N`` folder per micro-batch. A repeated batch
    replaces its own folder, which makes the export exactly once."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.format(format).mode("overwrite").save(f"{path}/batch_id={batch_id}")

    return write
