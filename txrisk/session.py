"""Session settings the operators rely on, and where scratch output goes."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def pin_utc(spark: SparkSession) -> SparkSession:
    """Dates and hours are taken from event time in UTC, never in local time."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_disk_backed_state(spark: SparkSession, once: bool = False) -> SparkSession:
    """Keep streaming state in RocksDB and upload only its changes per batch.

    Duplicates are remembered for ever by default, so state outgrows executor
    heaps; the default in-memory store would not hold it. Rows in it are not
    counted, which would cost a look-up per update; its size shows in the store's
    file metrics. Takes effect for streams started afterwards.

    Spark makes files of the state itself from time to time, beside a running stream.
    One that catches up ``once`` and ends has none made, and all changes since its first
    start would be replayed by the next one and by whoever reads its state. So it uploads
    the state's new files with every batch instead. Either goes on from the other.
    """
    store = "spark.sql.streaming.stateStore"
    settings = {
        f"{store}.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        f"{store}.rocksdb.changelogCheckpointing.enabled": "false" if once else "true",
        f"{store}.rocksdb.trackTotalNumberOfRows": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="txrisk-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the cluster's shared checkpoint folder.

    Only a local session may fall back on a machine-local folder: on a cluster
    other executors could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/txrisk/{name}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that its path names."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def folder_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.listStatus(path) if files.exists(path) else ()
    return sorted(status.getPath().getName() for status in found)


def mark_complete(spark: SparkSession, folder: str) -> None:
    """Write a folder that holds nothing but the mark of being complete."""
    spark.range(0).write.mode("overwrite").parquet(folder)


def complete_folders(spark: SparkSession, folder: str) -> dict[str, list[int]]:
    """By kind, the numbers of the folders ``kind=N`` that were written to the end,
    ascending (names only)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found: dict[str, list[int]] = {}
    for status in files.listStatus(path) if files.exists(path) else ():
        kind, _, number = status.getPath().getName().partition("=")
        if number.isdigit() and files.exists(hadoop.Path(status.getPath(), "_SUCCESS")):
            found.setdefault(kind, []).append(int(number))
    return {kind: sorted(numbers) for kind, numbers in found.items()}
