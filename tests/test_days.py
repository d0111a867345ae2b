"""Daily figures of touched days."""

from __future__ import annotations

import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from txrisk.plans.days import DAY, in_days_of, read_days, refresh_days, with_day
from txrisk.plans.gold import daily_kpis
from txrisk.streaming.hops import keep_days

from test_cells import rows_of, same


def digests(path: str) -> dict[str, str]:
    return {str(p): hashlib.sha256(p.read_bytes()).hexdigest() for p in Path(path).rglob("*.parquet")}


def append(rows, table: str, path: str) -> None:
    rows.write.mode("append").partitionBy(DAY).option("path", path).saveAsTable(table)


def test_four_growths_give_the_full_result(spark, table, tmp_path):
    """Rows of all days, of one day, of no day, and a day that is new."""
    rows = with_day(rows_of(spark, 4))
    one = F.col(DAY) == "2024-01-01"
    more = rows.filter(one).limit(1).withColumns({"event_ts": F.expr("timestamp'2024-03-01'")})
    path, out, checkpoint = str(tmp_path / "clean"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    parts = [rows.filter("event_id % 4 < 2"), rows.filter("event_id % 4 = 2").filter(one),
             rows.filter("event_id % 4 = 3 AND event_ts IS NULL"), with_day(more)]
    for part in parts:
        append(part, table, path)
        keep_days(spark, table, checkpoint, out, None).awaitTermination()
        assert same(read_days(spark, out), daily_kpis(spark.read.table(table)))
    keep_days(spark, table, checkpoint, out, None).awaitTermination()  # nothing new
    assert same(read_days(spark, out), daily_kpis(spark.read.table(table)))


def test_other_days_are_neither_read_nor_written(spark, table, tmp_path):
    rows = with_day(rows_of(spark, 4))
    path, out = str(tmp_path / "clean"), str(tmp_path / "out")
    append(rows, table, path)
    refresh_days(rows, spark.read.table(table), out)
    before = digests(out)
    touched = rows.filter(F.col(DAY) == "2024-01-01")
    append(touched, table, path)
    refresh_days(touched, spark.read.table(table), out)
    after = digests(out)
    changed = set(before.items()) ^ set(after.items())
    assert changed and all("event_date=2024-01-01" in name for name, _ in changed)
    assert same(read_days(spark, out), daily_kpis(spark.read.table(table)))
    figures = daily_kpis(spark.read.table(table).filter(in_days_of(touched)))
    figures.collect()
    plan = figures._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2024-01-01" in plan.split("PartitionFilters: ")[1][:200]
    scan = spark.read.table(table).filter(in_days_of(touched))
    assert all("event_date=2024-01-01" in f for f in scan.inputFiles())


def test_a_batch_given_again_replaces_its_days(spark, table, tmp_path):
    rows = with_day(rows_of(spark, 2))
    append(rows, table, str(tmp_path / "clean"))
    for _ in range(2):
        refresh_days(rows, spark.read.table(table), str(tmp_path / "out"))
    assert same(read_days(spark, str(tmp_path / "out")), daily_kpis(rows))


def test_a_failed_refresh_leaves_the_old_figures(spark, table, tmp_path):
    rows, out = with_day(rows_of(spark, 2)), str(tmp_path / "out")
    append(rows, table, str(tmp_path / "clean"))
    refresh_days(rows, spark.read.table(table), out)
    before = digests(out)
    bad = lambda df: daily_kpis(df).withColumn("avg_transaction_amount", F.expr("raise_error('no')"))
    with pytest.raises(Exception):
        refresh_days(rows, spark.read.table(table), out, bad)
    assert digests(out) == before
