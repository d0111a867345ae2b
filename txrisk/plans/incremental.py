"""The customer activity table, kept up to date by keyed increments."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.functions import measures as m
from txrisk.operators.merge import is_newer, merge_by_key, merge_into, newer_rows
from txrisk.plans.gold import summarise
from txrisk.plans.tables import refresh_view
from txrisk.session import pin_utc

Mode = Literal["replace", "recompute"]

KEY = "customer_id"
COMMENT = "Customer activity, kept by increments"


CELL = [KEY, "country", "merchant_category"]
ARRIVAL = "silver_processed_ts"


def activity_cells(silver: DataFrame, more: dict[str, Column] | None = None) -> DataFrame:
    """One row per customer, country and category, of figures that add up: combined
    inside each task before the shuffle."""
    return summarise(
        silver,
        CELL,
        {
            "transactions": m.rows(),
            "suspicious": m.flagged("is_suspicious_hint"),
            **m.money_parts("amount"),
            "largest": F.max("amount"),
            "newest": m.latest("event_ts"),
            **(more or {}),
        },
    )


def customer_activity(silver: DataFrame) -> DataFrame:
    """Per customer: totals, and how many different countries and categories.

    Two steps: cells, then the cells of each customer. Asking for both distinct
    counts directly would make Spark write every transaction three times over
    before it can combine anything.
    """
    return activity_of(activity_cells(silver))


def activity_of(cells: DataFrame, used: dict[str, Column] | None = None) -> DataFrame:
    """Per customer, from the cells of :func:`activity_cells`; ``used`` are the distinct
    counts, where cells hold other things than the values themselves."""
    money = m.add_parts()
    used = used or {
        "countries_used": m.distinct("country"),
        "merchant_categories_used": m.distinct("merchant_category"),
    }
    return summarise(
        cells,
        [KEY],
        {
            "transaction_count": F.sum("transactions"),
            "total_amount": m.money_total(money),
            "avg_amount": m.money_mean(money),
            "max_amount": m.peak("largest"),
            "suspicious_transaction_count": F.sum("suspicious"),
            **used,
            "last_event_ts": m.latest("newest"),
        },
    )


def increment(silver: DataFrame, target: DataFrame | None, mode: Mode = "replace") -> DataFrame:
    """The target's next state. Without a target: the activity of everyone.

    ``replace`` summarises only rows newer than the target's newest, and puts
    that in place of what the customer had: cheap, but a customer's figures then
    cover the last increment only, and rows without a customer pile up.
    ``recompute`` gives those customers the figures of their whole history, and
    reads all of it; :func:`fold` does not. It needs no join back to the transactions: a customer has newer rows exactly
    when their newest row is newer, which the summary itself tells. Rows without
    a customer are always recomputed. Either way late rows of other customers
    wait until the customer's next newer row.
    """
    if target is None:
        return _stamped(customer_activity(silver))
    if mode == "replace":
        changes = customer_activity(newer_rows(silver, target))
    elif mode == "recompute":
        anonymous = F.col(KEY).isNull()
        changes = customer_activity(silver).filter(is_newer("last_event_ts", target) | anonymous)
        target = target.filter(~anonymous)
    else:
        raise ValueError(f"mode must be replace or recompute, not {mode!r}")
    return merge_by_key(target, _stamped(changes), KEY)


def fold(silver: DataFrame, state: DataFrame | None) -> DataFrame:
    """The next state: cells with ``arrived``, the newest arrival in each.

    Only rows that reached the clean table after everything in the state are read,
    by a bound on their arrival that the scan is given; their cells are added to
    those kept. Late rows and rows of tied or no event time count like any others.
    The cost follows the increment and the number of cells, not the history.
    """
    newer = newer_rows(silver, state, ARRIVAL, "arrived")
    cells = activity_cells(newer, {"arrived": m.latest(ARRIVAL)})
    if state is None:
        return cells
    added = {
        "transactions": F.sum("transactions"),
        "suspicious": F.sum("suspicious"),
        **m.add_parts(),
        "largest": F.max("largest"),
        "newest": F.max("newest"),
        "arrived": F.max("arrived"),
    }
    return summarise(state.unionByName(cells), CELL, added).select(*state.columns)


def merge_increment(spark: SparkSession, clean_table: str, target: str) -> None:
    """``replace`` on a target whose format can merge: no row of another customer is
    written again. (Not run here: Spark's own formats cannot.)"""
    silver, current = pin_utc(spark).read.table(clean_table), spark.read.table(target)
    merge_into(_stamped(customer_activity(newer_rows(silver, current))), target, KEY)


def apply_fold(
    spark: SparkSession,
    clean_table: str,
    state: str,
    root: str | None = None,
    format: str = "parquet",
    buckets: int | None = None,
) -> str:
    """Bring the cells behind ``state`` up to date; ``activity_of`` reads them.

    Each call takes what the clean table holds now and the state does not.
    """
    silver = pin_utc(spark).read.table(clean_table)
    current = spark.read.table(state) if spark.catalog.tableExists(state) else None
    bucketed = (buckets, KEY) if buckets else None
    return refresh_view(fold(silver, current), state, COMMENT, root, format, bucketed=bucketed)


def _stamped(activity: DataFrame) -> DataFrame:
    return activity.withColumn("dbt_processed_ts", F.current_timestamp())


def apply_increment(
    spark: SparkSession,
    clean_table: str,
    target: str,
    mode: Mode = "replace",
    root: str | None = None,
    format: str = "parquet",
    buckets: int | None = None,
) -> str:
    """Bring ``target`` up to date with the clean table; returns the table behind it.

    The target's next state is written in full beside the one it is made from, as
    :func:`refresh_view` does for any result. With ``buckets`` it is bucketed and
    sorted by customer, and later runs need not shuffle it.
    """
    silver = pin_utc(spark).read.table(clean_table)
    current = spark.read.table(target) if spark.catalog.tableExists(target) else None
    bucketed = (buckets, KEY) if buckets else None
    state = increment(silver, current, mode)
    return refresh_view(state, target, COMMENT, root, format, bucketed=bucketed)
