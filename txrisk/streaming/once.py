"""Exactly-once export through connectors that can only append."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.session import complete_folders, delete_folder, mark_complete
from txrisk.streaming.sinks import WriteBatch

BATCH, ROW = "export_batch", "export_row"

Held = Callable[[SparkSession], DataFrame | None]


def append_once(stage: str, append: WriteBatch, held: Held) -> WriteBatch:
    """Writer that appends every row of a micro-batch once, though a batch be handed
    over again after any failure.

    A batch is first written under ``stage``, where each of its rows gets a number
    (columns ``export_batch``, ``export_row``, which the target keeps); then it is given
    to ``append``, and then noted as done. A batch that is handed over again is skipped
    if it is noted. If it was staged but not noted, nobody knows how much of it got
    there: the same staged rows are taken, ``held`` is asked what the target has of this
    batch (None: there is no target yet), and only the others are appended. So a
    failure costs one read of the target, and a run without one costs none.

    ``stage`` is a shared folder that belongs to one stream; its batches go once they
    are delivered. Tasks of a failed ``append`` must have ended. A connector whose tasks
    commit one by one may still repeat a task that was lost after its commit; the two
    columns are then the key by which the target can refuse it.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        found = complete_folders(spark, stage)
        done = found.get("done", [])
        if done and batch_id <= done[-1]:
            return
        folder, seen_before = f"{stage}/batch={batch_id}", batch_id in found.get("batch", [])
        numbered = rows.withColumns({BATCH: F.lit(batch_id).cast("long"), ROW: F.monotonically_increasing_id()})
        if not seen_before:
            numbered.write.mode("overwrite").parquet(folder)
        staged = spark.read.schema(numbered.schema).parquet(folder)
        target = held(spark) if seen_before else None
        if target is not None:
            there = target.filter(F.col(BATCH) == batch_id).select(ROW)
            staged = staged.join(there, ROW, "left_anti").select(*numbered.columns)
        append(staged, batch_id)
        mark_complete(spark, f"{stage}/done={batch_id}")
        for n in found.get("batch", []) + [batch_id]:
            delete_folder(spark, f"{stage}/batch={n}")
        for n in done:
            delete_folder(spark, f"{stage}/done={n}")

    return write
