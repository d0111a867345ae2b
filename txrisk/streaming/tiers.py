"""De-duplication for ever with state that stays small: two memories of ids.

The stream's state remembers an id for one watermark delay after its event time. Older
ids lie in a table. What passes the state is held against the table, and what passes
that too is new: the rows that come out are those of ``retention="forever"``, whose
state grows with every id there ever was.

The table of ids is bucketed by id, so that a batch is dealt to the buckets and the ids
are not moved; it is only ever appended to. Ids get there every ``FOLD_EVERY`` batches;
until then they are read from the rows themselves. A batch costs one pass over the id
column besides its own rows: use it where triggers are far apart and ids are many.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txrisk.plans.silver import clean
from txrisk.schema import CLEAN_INTERVAL, WATERMARK_DELAY
from txrisk.session import complete_folders, delete_folder, mark_complete, pin_utc, use_disk_backed_state
from txrisk.sources.tables import read_stream_table

FOLD_EVERY = 8  # batches
BUCKETS = 64  # of the ids; such that a bucket's ids fit a task
KEY = "event_id"


def _id_table(spark: SparkSession, root: str, buckets: int) -> str:
    """The ids as a bucketed table over its folder, declared anew in each session. The
    number of buckets belongs to the folder: give the same each time."""
    name = f"txrisk_ids_{hashlib.sha256(root.encode()).hexdigest()[:16]}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({KEY} STRING) USING parquet "
        f"CLUSTERED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{root}/ids'"
    )
    return name


def _rows_of(spark: SparkSession, root: str, batches: list[int], schema) -> DataFrame:
    return spark.read.schema(schema).parquet(*[f"{root}/rows/batch={n}" for n in batches])


def unknown(rows: DataFrame, root: str, before: int, buckets: int = BUCKETS) -> DataFrame:
    """Rows whose id no batch before ``before`` brought."""
    spark = rows.sparkSession
    folded = complete_folders(spark, root).get("folded", [])
    last = folded[-1] if folded else -1
    recent = [n for n in complete_folders(spark, f"{root}/rows").get("batch", []) if last < n < before]
    if folded:  # dealt to the buckets, however a stream's state has dealt them
        rows = rows.repartition(buckets, KEY)
        rows = rows.join(spark.read.table(_id_table(spark, root, buckets)), KEY, "left_anti")
    if recent:
        rows = rows.join(_rows_of(spark, root, recent, rows.schema).select(KEY), KEY, "left_anti")
    return rows


def apply_tier(
    rows: DataFrame, batch_id: int, root: str, buckets: int = BUCKETS, fold_every: int = FOLD_EVERY
) -> None:
    """Keep the rows of a micro-batch that no earlier batch brought, under its id.

    Rows are taken once, since each pass over a stateful stream's batch runs its
    state: they go through the joins into their folder in one job. Given again, a complete
    batch stays as it is, and its state is run alone. An append of ids that failed
    half-way is done again; an id that is there twice does no harm.
    """
    spark = rows.sparkSession
    kept = f"{root}/rows"
    done = complete_folders(spark, kept).get("batch", [])
    if batch_id in done:
        rows.write.format("noop").mode("overwrite").save()
    else:
        new = unknown(rows, root, batch_id, buckets).select(*rows.columns)
        new.write.mode("overwrite").parquet(f"{kept}/batch={batch_id}")
        done = sorted({*done, batch_id})
    folded = complete_folders(spark, root).get("folded", [])
    open_batches = [n for n in done if not folded or n > folded[-1]]
    if len(open_batches) >= fold_every:
        ids = _rows_of(spark, root, open_batches, rows.schema).select(KEY)
        table = _id_table(spark, root, buckets)
        ids.repartition(buckets, KEY).write.insertInto(table)
        mark_complete(spark, f"{root}/folded={open_batches[-1]}")
        spark.catalog.refreshTable(table)
        for n in folded:
            delete_folder(spark, f"{root}/folded={n}")


def refine_in_tiers(
    spark: SparkSession,
    raw_table: str,
    checkpoint: str,
    root: str,
    interval: str | None = CLEAN_INTERVAL,
    delay: str = WATERMARK_DELAY,
    source: dict[str, str] | None = None,
    buckets: int = BUCKETS,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Raw table to clean rows under ``root``, each id once for ever; read them by
    :func:`read_tiers`. Rules go first, so ids are never null."""
    use_disk_backed_state(pin_utc(spark), once=interval is None)
    raw = read_stream_table(spark, raw_table, **source or {})
    rows = clean(raw, delay=delay, retention="within_watermark")

    def keep(batch: DataFrame, batch_id: int) -> None:
        apply_tier(batch, batch_id, root, buckets, fold_every)

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(keep)
    once = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**once).start()


def read_tiers(spark: SparkSession, root: str) -> DataFrame | None:
    """The clean rows of all complete batches; None before the first."""
    batches = complete_folders(spark, f"{root}/rows").get("batch", [])
    folders = [f"{root}/rows/batch={n}" for n in batches]
    return spark.read.parquet(*folders) if folders else None


def remembered(spark: SparkSession, checkpoint: str, key: str = KEY) -> DataFrame:
    """The ids that a de-duplicating stream's state holds after its last batch, read from
    the checkpoint by Spark's state reader; the stream must not be running."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(F.col(f"key.{key}").alias(key))
