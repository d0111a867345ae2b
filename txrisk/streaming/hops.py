"""The three streaming jobs, each a query of its own between tables.

Broker -> raw table -> clean table -> outside. Each returns its running
``StreamingQuery``; ``interval=None`` makes it catch up once and end.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txrisk.operators.bronze import to_bronze
from txrisk.plans.cells import FOLD_EVERY, apply_batch
from txrisk.plans.days import DAY, refresh_days, with_day
from txrisk.plans.distinct import apply_bitmaps
from txrisk.plans.files import TARGET_BYTES, add_batch, close_days
from txrisk.plans.silver import clean
from txrisk.plans.tables import TABLES, Table, describe, refresh_views
from txrisk.schema import CLEAN_INTERVAL, EXPORT_INTERVAL, INGEST_INTERVAL, SOURCE_SYSTEM
from txrisk.session import pin_utc, use_disk_backed_state
from txrisk.sources.tables import read_stream_table
from txrisk.streaming.sinks import WriteBatch, export_stream, write_stream_table


def ingest(
    messages: DataFrame,
    table: str,
    checkpoint: str,
    interval: str | None = INGEST_INTERVAL,
    source_system: str = SOURCE_SYSTEM,
    **sink: object,
) -> StreamingQuery:
    """Message envelopes to the raw table."""
    raw = to_bronze(messages, source_system)
    return write_stream_table(raw, table, checkpoint, interval, **sink)


def refine(
    spark: SparkSession,
    raw_table: str,
    clean_table: str,
    checkpoint: str,
    interval: str | None = CLEAN_INTERVAL,
    source: dict[str, str] | None = None,
    sink: dict[str, object] | None = None,
    by_day: bool = False,
    **cleaning: object,
) -> StreamingQuery:
    """Raw table to clean table; ``cleaning`` goes to :func:`clean`. ``by_day`` puts its
    rows in folders by day of event time, with the day as a column.

    Sets the session to keep the state of streams on disk.
    """
    use_disk_backed_state(pin_utc(spark), once=interval is None)
    raw = read_stream_table(spark, raw_table, **source or {})
    rows = clean(raw, **cleaning)
    sink = dict(sink or {})
    if by_day:
        rows, sink["partition_by"] = with_day(rows), [DAY]
    return write_stream_table(rows, clean_table, checkpoint, interval, **sink)


def export(
    spark: SparkSession,
    clean_table: str,
    write_batch: WriteBatch,
    checkpoint: str,
    interval: str | None = EXPORT_INTERVAL,
    source: dict[str, str] | None = None,
) -> StreamingQuery:
    """Clean table to wherever ``write_batch`` puts a micro-batch."""
    return export_stream(
        read_stream_table(spark, clean_table, **source or {}), write_batch, checkpoint, interval
    )


def keep_fresh(
    spark: SparkSession,
    clean_table: str,
    checkpoint: str,
    names: dict[str, str] | None = None,
    root: str | None = None,
    interval: str | None = EXPORT_INTERVAL,
) -> StreamingQuery:
    """Refresh every declared view whenever the clean table has grown."""

    def refresh(_rows: DataFrame, _batch_id: int) -> None:
        refresh_views(spark, {**(names or {}), "transactions_clean": clean_table}, root)

    return export(spark, clean_table, refresh, checkpoint, interval)


def keep_cells(
    spark: SparkSession,
    clean_table: str,
    checkpoint: str,
    root: str,
    names: list[str] | None = None,
    interval: str | None = EXPORT_INTERVAL,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Add what is new in the clean table to the summaries' cells under ``root``; read
    them by :func:`read_summary`. A trigger costs what came in, however much there is.
    """

    def add(rows: DataFrame, batch_id: int) -> None:
        apply_batch(rows, batch_id, root, names, fold_every)

    return export(pin_utc(spark), clean_table, add, checkpoint, interval)


def keep_days(
    spark: SparkSession,
    clean_table: str,
    checkpoint: str,
    path: str,
    interval: str | None = EXPORT_INTERVAL,
) -> StreamingQuery:
    """Recompute the daily figures under ``path`` for the days that are new in the clean
    table, which lies in folders by day; read them by :func:`read_days`."""

    def refresh(rows: DataFrame, _batch_id: int) -> None:
        spark.catalog.refreshTable(clean_table)
        refresh_days(rows, spark.read.table(clean_table), path)

    return export(pin_utc(spark), clean_table, refresh, checkpoint, interval)


def keep_bitmaps(
    spark: SparkSession,
    clean_table: str,
    checkpoint: str,
    root: str,
    interval: str | None = EXPORT_INTERVAL,
    fold_every: int = FOLD_EVERY,
    spread: int = 1,
) -> StreamingQuery:
    """Add what is new in the clean table to the customers' bitmaps under ``root``; read
    them by :func:`read_activity`."""

    def add(rows: DataFrame, batch_id: int) -> None:
        apply_bitmaps(rows, batch_id, root, fold_every, spread)

    return export(pin_utc(spark), clean_table, add, checkpoint, interval)


def keep_sized(
    spark: SparkSession,
    clean_table: str,
    checkpoint: str,
    view: str,
    root: str,
    interval: str | None = EXPORT_INTERVAL,
    close_every: int = FOLD_EVERY,
    open_days: int = 1,
    target_bytes: int = TARGET_BYTES,
) -> StreamingQuery:
    """Keep the clean table's rows under ``view`` in files of ``target_bytes``: after every
    ``close_every`` batches, those of days more than ``open_days`` before the newest."""

    def add(rows: DataFrame, batch_id: int) -> None:
        add_batch(rows, batch_id, view, root)
        if batch_id % close_every == close_every - 1:
            newest = rows.agg(F.max(F.to_date("event_ts"))).first()[0]
            if newest is not None:
                before = newest - timedelta(days=open_days)
                close_days(spark, view, root, batch_id, before, target_bytes)

    return export(pin_utc(spark), clean_table, add, checkpoint, interval)


def catch_up(
    spark: SparkSession,
    messages: DataFrame,
    root: str,
    names: dict[str, str] | None = None,
    tables: dict[str, Table] = TABLES,
) -> None:
    """Bring every declared table up to what the source holds now, in order, and end.

    Run again, it takes only what is new since. ``root`` is a shared folder for
    checkpoints and for the files of the tables; ``names`` gives declared tables
    other names.
    """
    use_disk_backed_state(pin_utc(spark), once=True)
    called = {name: name for name in tables} | (names or {})
    for name, spec in tables.items():
        if spec.kind == "stream":
            source = read_stream_table(spark, called[spec.reads]) if spec.reads else messages
            write_stream_table(
                spec.query(source),
                called[name],
                f"{root}/{name}.checkpoint",
                interval=None,
                path=f"{root}/{name}",
            ).awaitTermination()
            describe(spark, called[name], spec.comment)
    refresh_views(spark, names, root, tables)
