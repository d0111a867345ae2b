"""A clean table kept in files of a size worth reading.

A stream writes a file per day and trigger. They lie in folders by batch and day, the
open part; now and then the days that are over are written again, as few files of the
wanted size, into the closed part. Readers ask a view over both parts. It says which
batches and days are closed, and replacing it is the one act that publishes them:
before it a reader sees the small files only, after it the large ones only.

A row is written again once. What comes late for a closed day is open until the next
time, which puts it beside the day's other files.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txrisk.plans.days import DAY, with_day
from txrisk.session import delete_folder, folder_names

BATCH = "batch"
TARGET_BYTES = 128 << 20


def _parts(view: str) -> dict[str, str]:
    return {"open": f"{view}__open", "closed": f"{view}__closed"}


def _closed_until(spark: SparkSession, view: str) -> tuple[int, dt.date]:
    """The last batch that was closed, and the first day that is still open."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {view}").collect()
    found = {r["key"]: r["value"] for r in rows}
    return int(found["upto"]), dt.date.fromisoformat(found["before"])


def _is_open(upto: int, before: dt.date) -> str:
    """Whether rows are behind that mark, as a filter on folders; a null day is over."""
    return f"({BATCH} > {upto} OR coalesce({DAY} >= DATE'{before}', false))"


def _publish(spark: SparkSession, view: str, upto: int, before: dt.date) -> None:
    parts = _parts(view)
    names = ", ".join(f"`{c}`" for c in spark.read.table(parts["open"]).columns if c != BATCH)
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('upto' = '{upto}', 'before' = '{before}') AS "
        f"SELECT {names} FROM {parts['closed']} WHERE {BATCH} <= {upto} UNION ALL "
        f"SELECT {names} FROM {parts['open']} WHERE {_is_open(upto, before)}"
    )


def _numbered(spark: SparkSession, folder: str) -> list[int]:
    return [int(n.partition("=")[2]) for n in folder_names(spark, folder) if n.startswith(f"{BATCH}=")]


def _write(rows: DataFrame, view: str, root: str, part: str) -> None:
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(BATCH, DAY).parquet(f"{root}/{part}")
    rows.sparkSession.catalog.refreshTable(_parts(view)[part])


def add_batch(rows: DataFrame, batch_id: int, view: str, root: str) -> None:
    """Add a micro-batch to the table behind ``view``, whose files lie under ``root``.
    Given again, it replaces itself, or changes nothing once it is closed.

    The rows of a day are brought together by a hint, which splits them again where a
    day is large: a batch writes a file per day, not one per day and task.
    """
    spark = rows.sparkSession
    rows = with_day(rows).withColumn(BATCH, F.lit(batch_id).cast("bigint"))
    for part, table in _parts(view).items():
        if not spark.catalog.tableExists(table):
            # Not declared by partition: what there is, the folders tell and no catalog.
            spark.catalog.createTable(table, f"{root}/{part}", "parquet", rows.schema)
    if not spark.catalog.tableExists(view):
        _publish(spark, view, -1, dt.date.min)
    if batch_id > _closed_until(spark, view)[0]:
        _write(rows.hint("rebalance", DAY), view, root, "open")


def close_days(
    spark: SparkSession,
    view: str,
    root: str,
    upto: int,
    before: dt.date,
    target_bytes: int = TARGET_BYTES,
) -> None:
    """Write the rows of batches up to ``upto`` that belong to days before ``before``
    again, each day as its size divided by ``target_bytes``, rounded up, in files.

    Reads and writes what became closed since the last time, not the days closed then. A
    run that fails leaves files that no view names, which the next run deletes. The small
    files go one run later, so that readers which began on them can finish. One writer at
    a time; other sessions see the new parts after ``REFRESH TABLE``.
    """
    parts, (closed, over) = _parts(view), _closed_until(spark, view)
    upto, before = max(upto, closed), max(before, over)
    _delete_replaced(spark, f"{root}/open", closed, over)
    for n in _numbered(spark, f"{root}/closed"):
        if n > closed:
            delete_folder(spark, f"{root}/closed/{BATCH}={n}")
    for table in parts.values():
        spark.catalog.refreshTable(table)

    pending = spark.read.table(parts["open"]).filter(f"{_is_open(closed, over)} AND NOT {_is_open(upto, before)}")
    files = pending.select(DAY, "_metadata.file_path", "_metadata.file_size").distinct()
    # A row a day from here on: as many as the calendar has.
    pieces = files.groupBy(DAY).agg(F.ceil(F.sum("file_size") / target_bytes).alias("pieces"))
    until = F.sum("pieces").over(Window.orderBy(DAY))
    places = pieces.select(F.col(DAY).alias("day"), "pieces", (until - F.col("pieces")).alias("first"))
    total = places.agg(F.sum("pieces")).first()[0]
    if total and (upto, before) != (closed, over):
        columns = pending.columns
        dealt = pending.join(F.broadcast(places), F.col(DAY).eqNullSafe(F.col("day")))
        # Rows are spread by all they hold (but maps, which have no hash), so that no key
        # makes one piece large.
        held = [f.name for f in pending.schema if "map<" not in f.dataType.simpleString()]
        spread = F.pmod(F.xxhash64(*held), F.col("pieces"))
        dealt = dealt.repartitionById(int(total), (F.col("first") + spread).cast("int"))
        generation = F.lit(upto).cast("bigint")
        _write(dealt.select(*columns).withColumn(BATCH, generation), view, root, "closed")
    _publish(spark, view, upto, before)


def _delete_replaced(spark: SparkSession, folder: str, upto: int, before: dt.date) -> None:
    """Delete the small files that the view has not named since the last closing."""
    for n in _numbered(spark, folder):
        if n > upto:
            continue
        batch = f"{folder}/{BATCH}={n}"
        days = [d for d in folder_names(spark, batch) if d.startswith(f"{DAY}=")]
        still = [d for d in days if d[len(DAY) + 1 :] >= str(before) and d[len(DAY) + 1].isdigit()]
        for day in set(days) - set(still):
            delete_folder(spark, f"{batch}/{day}")
        if not still:
            delete_folder(spark, batch)
