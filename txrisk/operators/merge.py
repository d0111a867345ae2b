"""Incremental building blocks: rows above the high-water mark, keyed upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.functions.scalars import high_water


def is_newer(ts: str, target: DataFrame, target_ts: str = "last_event_ts") -> Column:
    """Whether a time is strictly above everything in the target.

    The mark is one value for the whole target, taken by a scalar subquery that
    Spark evaluates first and then hands to the scan as a plain bound.
    """
    return F.col(ts) > target.select(high_water(target_ts)).scalar()


def newer_rows(
    df: DataFrame, target: DataFrame | None, ts: str = "event_ts", target_ts: str = "last_event_ts"
) -> DataFrame:
    """Rows strictly newer than anything in the target; all rows without a target."""
    return df if target is None else df.filter(is_newer(ts, target, target_ts))


def merge_into(changes: DataFrame, target: str, key: str) -> None:
    """The same, in place, for a table format with row-level changes: only what
    holds changed keys is written again. Null keys match nothing and are added."""
    matches = F.col(f"{target}.{key}") == F.col(f"new.{key}")
    merge = changes.alias("new").mergeInto(target, matches)
    merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()


def merge_by_key(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Target rows with a changed key give way to the changed row.

    A null key matches nothing, so null-keyed rows pile up from both sides. Both
    sides hold a key once, and one outer join takes the changes once: leaving
    changed keys out and adding the changes would compute them twice.
    """
    old, new = target.alias("old"), changes.withColumn("_new", F.lit(True)).alias("new")
    both = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    changed = F.col("new._new")
    return both.select(
        *[
            F.when(changed, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)
            for name in target.columns
        ]
    )


BUCKET = "_bucket"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table kept by :func:`upsert_buckets`."""
    return spark.read.parquet(path).drop(BUCKET)


def upsert_buckets(changes: DataFrame, path: str, key: str, buckets: int) -> None:
    """Upsert by key into a table of files that lie in folders by bucket of the key.

    Buckets without a change are neither read nor written: their numbers (at most
    ``buckets``) become a partition filter, and dynamic overwriting replaces the others
    only. A change puts its row in place of the key's; rows of null key are added. The
    number of buckets belongs to the table: give the same each time, such that a bucket
    is some 100 MB. New files are written beside the old ones and put in their place at
    the end, bucket by bucket: the same changes given again after a failure mend what
    it left, but for rows of null key.
    """
    spark = changes.sparkSession
    changes = changes.withColumn(BUCKET, _bucket(key, buckets))
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(where):
        touched = [r[0] for r in changes.select(BUCKET).distinct().collect()]
        current = spark.read.parquet(path).filter(F.col(BUCKET).isin(touched))
        merged = merge_by_key(current.select(*changes.columns), changes, key)
    else:
        merged = changes
    dealt = merged.repartition(buckets, BUCKET)
    writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(BUCKET).parquet(path)
