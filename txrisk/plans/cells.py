"""Summaries kept as cells that add up: a refresh reads what is new, not the history.

Each micro-batch of the clean table is summarised by itself, and its few rows, the
cells, are written under the batch's id. A summary is the sum over cells. Now and then
the cells so far are folded into one set, the base, so that a reader never has more
than ``FOLD_EVERY`` batches to add.

What has been applied is told by folders alone, and each counts only once it is
complete: ``batch=N`` holds the cells of one batch, ``base=N`` those of all batches up
to ``N``. So the ledger is published by the same act as the state. A batch that is
handed over again after a failure is found there and skipped, or written again if it was
not complete. It is the stream's own offsets that decide what a batch holds: no clock
does, and late rows or rows of equal times count like any others.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.functions import measures as m
from txrisk.functions.scalars import percentage
from txrisk.plans.gold import summarise
from txrisk.plans.incremental import CELL, activity_cells, activity_of
from txrisk.session import complete_folders, delete_folder

FOLD_EVERY = 8  # batches


@dataclass(frozen=True)
class Cells:
    """A summary by its cells: how clean rows become cells, cells fewer cells, and cells
    the summary."""

    keys: list[str]
    of_rows: Callable[[DataFrame], DataFrame]
    to_summary: Callable[[DataFrame], DataFrame]
    largest: tuple[str, ...] = field(default=("largest", "newest"))  # the others are sums
    bitmaps: tuple[str, ...] = ()  # but for these, which are united

    def folded(self, cells: DataFrame) -> DataFrame:
        def part(name: str) -> Column:
            if name in self.bitmaps:
                return F.bitmap_or_agg(name)
            return F.max(name) if name in self.largest else F.sum(name)

        parts = {c: part(c) for c in cells.columns if c not in self.keys}
        return summarise(cells, self.keys, parts).select(*cells.columns)


def _additive(
    keys: dict[str, Column | str], counts: dict[str, str], figures: dict[str, Column], then: dict[str, Column] | None = None
) -> Cells:
    """Cells by the summary's own keys; ``counts`` are occurrences of columns."""

    def of_rows(silver: DataFrame) -> DataFrame:
        parts = {
            "transactions": m.rows(),
            **m.money_parts("amount"),
            "largest": F.max("amount"),
            "suspicious": m.flagged_or_null("is_suspicious_hint"),
            **{name: m.given(column) for name, column in counts.items()},
            "newest": m.latest("event_ts"),
        }
        named = [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in keys.items()]
        return summarise(silver, named, parts)

    def to_summary(cells: DataFrame) -> DataFrame:
        return summarise(cells, list(keys), figures).withColumns(then or {})

    return Cells(list(keys), of_rows, to_summary)


def _money() -> tuple[Column, Column]:
    parts = m.add_parts()
    return m.money_total(parts), m.money_mean(parts)


def _summaries() -> dict[str, Cells]:
    total, mean = _money()
    shared = {"transaction_count": F.sum("transactions"), "total_amount": total}
    last = {"last_transaction_ts": m.latest("newest")}
    suspicious = {"suspicious_transaction_count": F.sum("suspicious")}
    observed = lambda *names: {n: F.sum(n) for n in names}
    return {
        "customer_risk_summary": _additive(
            {"customer_id": "customer_id"},
            {"country_observation_count": "country", "merchant_category_observation_count": "merchant_category"},
            {
                **shared,
                "avg_amount": mean,
                "max_amount": m.peak("largest"),
                **suspicious,
                **observed("country_observation_count", "merchant_category_observation_count"),
                **last,
            },
        ),
        "merchant_risk_summary": _additive(
            {c: c for c in ("merchant_id", "merchant_name", "merchant_category")},
            {"customer_observation_count": "customer_id", "country_observation_count": "country"},
            {
                **shared,
                "avg_amount": mean,
                **suspicious,
                **observed("customer_observation_count", "country_observation_count"),
                **last,
            },
        ),
        "daily_kpis": _additive(
            {"transaction_date": F.to_date("event_ts")},
            {"customer_observation_count": "customer_id", "merchant_observation_count": "merchant_id"},
            {
                **shared,
                "avg_transaction_amount": mean,
                **suspicious,
                **observed("customer_observation_count", "merchant_observation_count"),
                **last,
            },
            {"suspicious_rate_pct": percentage(F.col("suspicious_transaction_count"), F.col("transaction_count"))},
        ),
        # Distinct countries and categories do not add up over batches; their cells do.
        "customer_activity": Cells(CELL, activity_cells, activity_of),
    }


def _complete(spark: SparkSession, folder: str) -> dict[str, list[int]]:
    """Numbers of the complete ``batch=N`` and ``base=N`` folders (names only)."""
    return {"batch": [], "base": []} | complete_folders(spark, folder)


def applied_folders(spark: SparkSession, folder: str) -> list[str]:
    """The folders whose cells, taken together, are the state: the newest base and the
    batches behind it."""
    found = _complete(spark, folder)
    base = found["base"][-1:]
    newer = [n for n in found["batch"] if not base or n > base[0]]
    return [f"{folder}/base={n}" for n in base] + [f"{folder}/batch={n}" for n in newer]


def read_cells(spark: SparkSession, folder: str) -> DataFrame | None:
    """The cells behind a summary; None before the first batch."""
    folders = applied_folders(spark, folder)
    return spark.read.parquet(*folders) if folders else None


def read_summary(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A summary as of the batches applied so far; None before the first."""
    cells = read_cells(spark, f"{root}/{name}")
    return None if cells is None else _summaries()[name].to_summary(cells)


def apply_batch(
    rows: DataFrame, batch_id: int, root: str, names: list[str] | None = None, fold_every: int = FOLD_EVERY
) -> None:
    """Add a micro-batch to the cells of each summary. Given again, it changes nothing.

    One writer at a time, as one stream is. Readers see a batch in a summary whole or
    not at all; summaries follow each other within a batch.
    """
    for name, cells in _summaries().items():
        if names is None or name in names:
            add_cells(rows, batch_id, f"{root}/{name}", cells, fold_every)


def add_cells(rows: DataFrame, batch_id: int, folder: str, cells: Cells, fold_every: int = FOLD_EVERY) -> None:
    """Add a micro-batch to the cells under ``folder``. Given again, it changes nothing."""
    spark = rows.sparkSession
    found = _complete(spark, folder)
    if batch_id not in found["batch"] and not (found["base"] and batch_id <= found["base"][-1]):
        cells.of_rows(rows).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
    if len(applied_folders(spark, folder)) > fold_every:
        _fold(spark, cells, folder)


def _fold(spark: SparkSession, cells: Cells, folder: str) -> None:
    """All cells so far as one set. Readers go on with the old folders until the new one
    is complete; those it replaces are then deleted, but for the ones of the fold
    before, which a reader may still be at."""
    before = _complete(spark, folder)
    last = max(before["batch"][-1:] + before["base"][-1:])
    cells.folded(read_cells(spark, folder)).write.mode("overwrite").parquet(f"{folder}/base={last}")
    if before["base"]:
        kept = before["base"][-1]
        for kind, numbers in before.items():
            for n in numbers:
                if n < kept or (kind == "batch" and n == kept):
                    delete_folder(spark, f"{folder}/{kind}={n}")
