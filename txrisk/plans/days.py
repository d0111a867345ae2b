"""Daily figures kept by recomputing the days that an increment touched.

The clean table lies in folders by day of event time. What came in names its days,
those days alone are read again (a partition filter) and their figures replace the old
ones (dynamic overwriting). Unlike sums of cells this also serves figures that do not
add up, and rows that are corrected or deleted in place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.plans.gold import daily_kpis

DAY = "event_date"


def with_day(rows: DataFrame, ts: str = "event_ts") -> DataFrame:
    """Rows with the day that decides their folder; null for rows without a time."""
    return rows.withColumn(DAY, F.to_date(ts))


def in_days_of(rows: DataFrame) -> Column:
    """Whether a row lies in a day that ``rows`` touch, as a filter on folders.

    The days go through the driver: as many as the calendar has, whatever comes in.
    """
    days = [r[0] for r in rows.select(DAY).distinct().collect()]
    known = F.col(DAY).isin([d for d in days if d is not None])
    return known | F.col(DAY).isNull() if None in days else known


def refresh_days(
    rows: DataFrame,
    table: DataFrame,
    path: str,
    figures: Callable[[DataFrame], DataFrame] = daily_kpis,
    day: str = "transaction_date",
) -> None:
    """Bring the figures under ``path`` up to date with ``table`` in the days of ``rows``.

    ``table`` holds all clean rows, those of ``rows`` included. Given again, it writes
    the same or something newer: days are replaced, never added to. Days that nothing
    touched keep their files, byte for byte.
    """
    spark = rows.sparkSession
    hit = in_days_of(rows)
    fresh = figures(table.filter(hit)).withColumn(DAY, F.col(day))
    writer = fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(DAY).parquet(path)
    spark.catalog.refreshByPath(path)


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """The figures kept by :func:`refresh_days`."""
    return spark.read.parquet(path).drop(DAY)
