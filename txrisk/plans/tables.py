"""The declared tables, and how a result table is replaced."""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import DataFrame, SparkSession

from txrisk.operators.bronze import to_bronze
from txrisk.plans.gold import customer_risk_summary, daily_kpis, merchant_risk_summary
from txrisk.plans.silver import clean
from txrisk.session import delete_folder, pin_utc


@dataclass(frozen=True)
class Table:
    """A table by its query over the one it reads.

    A ``stream`` grows by what is new in its source; a ``view`` is the full result
    of a batch query, replaced at each refresh. ``reads`` is None for the table
    that takes the messages themselves.
    """

    kind: Literal["stream", "view"]
    comment: str
    query: Callable[[DataFrame], DataFrame]
    reads: str | None


TABLES = {
    "transactions_raw": Table("stream", "Messages as they came, unchanged", to_bronze, None),
    "transactions_clean": Table(
        "stream", "Typed, valid, unique transactions", clean, "transactions_raw"
    ),
    "customer_risk_summary": Table(
        "view", "Risk summary per customer", customer_risk_summary, "transactions_clean"
    ),
    "merchant_risk_summary": Table(
        "view", "Risk summary per merchant", merchant_risk_summary, "transactions_clean"
    ),
    "daily_kpis": Table(
        "view", "Daily transaction and risk figures", daily_kpis, "transactions_clean"
    ),
}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def describe(spark: SparkSession, table: str, comment: str) -> None:
    spark.sql(f"COMMENT ON TABLE {table} IS {_quoted(comment)}")


def refresh_view(
    df: DataFrame,
    target: str,
    comment: str = "",
    root: str | None = None,
    format: str = "parquet",
    keep: int = 2,
    bucketed: tuple[int, str] | None = None,
) -> str:
    """Make ``target`` the query's full result; returns the table now behind it.

    ``target`` is a view over tables numbered by the clock: the next one is written
    in full, then the view is pointed at it. Readers see the old result or the new
    one, a run that fails on the way leaves the old one in place, and ``df`` may
    read ``target`` itself. The newest ``keep`` tables stay, so that readers which
    began on the one before can finish. Runs on one target must not overlap.

    Files go under ``root`` if given, and there a dropped table's folder goes with it.
    ``bucketed`` is a number of buckets and the column that decides.
    """
    spark = df.sparkSession
    table = f"{target}__{time.time_ns() // 1_000_000}"
    writer = df.write.format(format)
    if root:
        writer = writer.option("path", _folder(root, table))
    if bucketed:
        writer = writer.bucketBy(*bucketed).sortBy(bucketed[1])
    writer.saveAsTable(table)
    spark.sql(
        f"CREATE OR REPLACE VIEW {target} COMMENT {_quoted(comment)} AS SELECT * FROM {table}"
    )
    for old in _numbered_tables(spark, target)[:-keep]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")
        if root:
            delete_folder(spark, _folder(root, old))
    return table


def _folder(root: str, table: str) -> str:
    return f"{root}/{table.rpartition('.')[2]}"


def _numbered_tables(spark: SparkSession, target: str) -> list[str]:
    """The tables written for ``target``, oldest first (names only, from the catalog)."""
    schema, _, name = target.rpartition(".")
    where = f" IN {schema}" if schema else ""
    listed = spark.sql(f"SHOW TABLES{where} LIKE '{name}__*'").collect()
    numbered = re.compile(rf"{re.escape(name)}__\d+", re.IGNORECASE)
    names = sorted(row.tableName for row in listed if numbered.fullmatch(row.tableName))
    return [f"{schema}.{n}" if schema else n for n in names]


def refresh_views(
    spark: SparkSession,
    names: dict[str, str] | None = None,
    root: str | None = None,
    tables: dict[str, Table] = TABLES,
) -> None:
    """Refresh every declared view from the table it reads.

    ``names`` gives declared tables other names; files go under ``root`` if given.
    """
    pin_utc(spark)
    called = {name: name for name in tables} | (names or {})
    for name, spec in tables.items():
        if spec.kind == "view":
            source = spark.read.table(called[spec.reads])
            refresh_view(spec.query(source), called[name], spec.comment, root)
