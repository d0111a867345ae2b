"""Exact distinct counts that add up: bitmaps over numbered values.

Cells by customer, country and category grow with every combination that a customer
uses. Here each different country and category gets a number, once and for ever, and a
customer's cell holds a bitmap of the numbers seen. Bitmaps are united where others are
added, and the count is that of set bits: nothing is estimated. The state is one row
per customer (and one more for each 32,768 numbers, see ``spread``).

Numbers are cells themselves, so that ledger, folds and batches that are handed over
again are those of :mod:`txrisk.plans.cells`. A batch first numbers the values that
nobody has seen, then writes its bitmaps: if it fails in between, the numbers stand and
the next try finds them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txrisk.plans.cells import FOLD_EVERY, Cells, add_cells, read_cells
from txrisk.plans.gold import summarise
from txrisk.plans.incremental import CELL, KEY, activity_cells, activity_of

BITS = 32768  # of one of Spark's bitmaps
PART = "part"  # which bitmap of a value's numbers
BITMAPS = {column: f"{column}_bits" for column in CELL if column != KEY}
_LARGEST = ("largest", "newest")


def numbers(column: str, folder: str, spread: int = 1) -> Cells:
    """Cells that number a column's values from 1: ``value, slot, id``.

    Values are numbered inside ``spread`` slots by hash, each slot by a task of its own;
    a slot takes bitmaps in turn with the others, so that numbers stay dense. One slot is
    right for countries; take more for values in millions. Numbers never change.
    """

    def of_rows(rows: DataFrame) -> DataFrame:
        values = rows.select(F.col(column).alias("value")).filter("value IS NOT NULL").distinct()
        known = read_cells(rows.sparkSession, folder)
        if known is not None:
            values = values.join(known, "value", "left_anti")
        values = values.withColumn("slot", F.pmod(F.xxhash64("value"), F.lit(spread)))
        place = F.row_number().over(Window.partitionBy("slot").orderBy("value")) - 1
        if known is None:
            placed = values.withColumn("place", place.cast("long"))
        else:
            taken = known.groupBy("slot").agg(F.count("*").alias("taken"))
            placed = values.join(taken, "slot", "left").withColumn(
                "place", place + F.coalesce("taken", F.lit(0))
            )
        number = f"(place DIV {BITS} * {spread} + slot) * {BITS} + place % {BITS} + 1"
        return placed.select("value", "slot", F.expr(number).alias("id"))

    return Cells(["value"], of_rows, lambda cells: cells, largest=("slot", "id"))


def bitmap_cells(silver: DataFrame, known: dict[str, DataFrame]) -> DataFrame:
    """One row per customer and bitmap, of figures that add up and bitmaps that unite.

    Rows are combined to one per customer, country and category first, so that a
    country that a third of them have meets its number once a customer.
    """
    cells = activity_cells(silver)
    figures = [c for c in cells.columns if c not in CELL]
    for column, values in known.items():
        named = values.select(F.col("value").alias(column), F.col("id").alias(f"{column}_id"))
        cells = cells.join(named, column, "left")
    at = {column: F.bitmap_bucket_number(f"{column}_id") for column in known}
    parts = F.array_distinct(F.array(*[F.coalesce(number, F.lit(1)) for number in at.values()]))
    parted = cells.select("*", F.posexplode(parts).alias("nth", PART))
    # A row whose values lie in two bitmaps has its figures counted with the first.
    counted = {c: F.when(F.col("nth") == 0, F.col(c)) for c in figures}
    bits = {
        BITMAPS[c]: F.bitmap_construct_agg(F.when(number == F.col(PART), F.bitmap_bit_position(f"{c}_id")))
        for c, number in at.items()
    }
    combined = {c: F.max(v) if c in _LARGEST else F.sum(v) for c, v in counted.items()}
    return summarise(parted, [KEY, PART], {**combined, **bits})


def _cells(known: dict[str, DataFrame] | None = None) -> Cells:
    return Cells(
        [KEY, PART], lambda silver: bitmap_cells(silver, known), activity_by_bitmaps, bitmaps=tuple(BITMAPS.values())
    )


def activity_by_bitmaps(cells: DataFrame) -> DataFrame:
    """The customer activity, from the cells of :func:`bitmap_cells` of one or more batches."""
    cells = _cells().folded(cells)
    bits = {column: F.sum(F.bitmap_count(name)) for column, name in BITMAPS.items()}
    used = {"countries_used": bits["country"], "merchant_categories_used": bits["merchant_category"]}
    return activity_of(cells, used)


def apply_bitmaps(
    rows: DataFrame, batch_id: int, root: str, fold_every: int = FOLD_EVERY, spread: int = 1
) -> None:
    """Add a micro-batch to the numbers and bitmaps under ``root``. Given again, it
    changes nothing. ``spread`` belongs to ``root``: give the same each time."""
    spark = rows.sparkSession
    for column in BITMAPS:
        folder = f"{root}/{column}"
        add_cells(rows, batch_id, folder, numbers(column, folder, spread), fold_every)

    known = {column: read_cells(spark, f"{root}/{column}") for column in BITMAPS}
    add_cells(rows, batch_id, f"{root}/{KEY}", _cells(known), fold_every)


def read_activity(spark: SparkSession, root: str) -> DataFrame | None:
    """The customer activity as of the batches applied so far; None before the first."""
    cells = read_cells(spark, f"{root}/{KEY}")
    return None if cells is None else activity_by_bitmaps(cells)
