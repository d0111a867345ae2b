"""Exactly-once export through appending connectors, and rule counts of streams."""

from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from txrisk.operators.rules import rule_counts, watch_rules
from txrisk.session import complete_folders
from txrisk.sources.tables import read_stream_table
from txrisk.streaming.ledger import RuleLedger, read_ledger, rule_totals
from txrisk.streaming.once import BATCH, ROW, append_once
from txrisk.streaming.sinks import append_to, export_stream, write_stream_table


class Target:
    """An appending connector that dies once, after the rows that ``until`` names."""

    def __init__(self, path: str):
        self.path, self.until, self.asked = path, None, 0
        self.append = append_to("parquet", path=path)

    def write(self, rows, batch_id):
        until, self.until = self.until, None
        self.append(rows.filter(until) if until else rows, batch_id)
        if until:
            raise ConnectionError("lost")

    def held(self, spark):
        self.asked += 1
        try:
            return spark.read.parquet(self.path)
        except Exception:
            return None


@pytest.mark.parametrize("until", ["false", f"{ROW} % 2 = 0", "true"])
def test_a_failed_append_is_completed(spark, tmp_path, until):
    target = Target(str(tmp_path / "out"))
    write = append_once(str(tmp_path / "stage"), target.write, target.held)
    rows = spark.range(100).repartition(3)
    write(rows, 0)
    target.until = until
    with pytest.raises(ConnectionError):
        write(spark.range(100, 160), 1)
    write(spark.range(100, 160), 1)
    write(spark.range(100, 160), 1)
    write(rows, 0)
    out = spark.read.parquet(target.path)
    assert sorted(r.id for r in out.collect()) == list(range(160))
    assert out.select(BATCH, ROW).distinct().count() == 160
    assert target.asked == 1  # only where it was in doubt
    assert complete_folders(spark, str(tmp_path / "stage")) == {"done": [1]}


def test_a_first_batch_that_never_arrived(spark, tmp_path):
    target = Target(str(tmp_path / "out"))

    def refuse(rows, batch_id):
        raise ConnectionError("refused")

    with pytest.raises(ConnectionError):
        append_once(str(tmp_path / "stage"), refuse, target.held)(spark.range(5), 0)
    append_once(str(tmp_path / "stage"), target.write, target.held)(spark.range(5), 0)
    assert spark.read.parquet(target.path).count() == 5


def test_a_batch_that_reads_otherwise_the_second_time(spark, tmp_path):
    """Rows are numbered once: what was staged is delivered, in whatever order it is read."""
    target = Target(str(tmp_path / "out"))
    write = append_once(str(tmp_path / "stage"), target.write, target.held)
    target.until = f"{ROW} < 20"
    with pytest.raises(ConnectionError):
        write(spark.range(50).orderBy("id").coalesce(1), 0)
    write(spark.range(50).orderBy(F.desc("id")).coalesce(1), 0)
    assert sorted(r.id for r in spark.read.parquet(target.path).collect()) == list(range(50))


def test_a_failure_between_append_and_note(spark, table, tmp_path, monkeypatch):
    target = Target(str(tmp_path / "out"))
    write = append_once(str(tmp_path / "stage"), target.write, target.held)

    def run():
        stream = read_stream_table(spark, table)
        export_stream(stream, write, str(tmp_path / "checkpoint"), None).awaitTermination()

    spark.range(10).write.saveAsTable(table)
    run()
    spark.range(10, 30).write.mode("append").saveAsTable(table)

    def fail(*_):
        raise OSError("no space")

    with monkeypatch.context() as broken:
        broken.setattr("txrisk.streaming.once.mark_complete", fail)
        with pytest.raises(StreamingQueryException):
            run()
    run()
    assert sorted(r.id for r in spark.read.parquet(target.path).collect()) == list(range(30))


RULES = {"small": "id < 70", "even": "id % 2 = 0 OR id IS NULL"}


def test_rule_counts_over_restarts(spark, table, tmp_path):
    root = str(tmp_path / "ledger")
    ledger = RuleLedger(spark, root, "watched")
    spark.streams.addListener(ledger)
    try:
        for part in (range(40), range(40, 80), None, range(80, 120)):
            if part:
                spark.range(part.start, part.stop).write.mode("append").saveAsTable(table)
            rows = watch_rules(read_stream_table(spark, table), "watched", RULES)
            query = write_stream_table(rows, f"{table}_out", str(tmp_path / "checkpoint"), None)
            query.awaitTermination()
            ledger.settle(query)
    finally:
        spark.streams.removeListener(ledger)
    want = {tuple(r) for r in rule_counts(spark.read.table(table), RULES).collect()}
    assert {tuple(r) for r in rule_totals(spark, root).collect()} == want
    noted = read_ledger(spark, root)
    assert noted.count() == 6 and noted.select("query_id").distinct().count() == 1


def test_a_batch_reported_again_is_noted_once(spark, tmp_path):
    class Event:
        class progress:
            id, batchId = "q", 4
            observedMetrics = {"quality": spark.range(1).selectExpr("10L AS rows", "3L AS a", "0L AS b").first()}

    ledger = RuleLedger(spark, str(tmp_path))
    ledger.onQueryProgress(Event)
    ledger.onQueryProgress(Event)
    got = sorted(map(tuple, read_ledger(spark, str(tmp_path)).collect()))
    assert got == [("a", 7, 3, "q", 4), ("b", 10, 0, "q", 4)]
    with pytest.raises(TimeoutError):
        ledger.settle(type("Query", (), {"runId": "none"}), timeout=0.1)
