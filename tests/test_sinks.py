"""Hops between tables: restart, export, refresh."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from catalogue import feed
from txrisk.operators.bronze import to_bronze
from txrisk.plans.silver import clean
from txrisk.plans.tables import TABLES, refresh_view, refresh_views
from txrisk.session import scratch_path
from txrisk.sources.tables import read_envelope_files, read_stream_table
from txrisk.streaming.hops import catch_up, export, ingest, refine
from txrisk.streaming.sinks import append_to, export_stream, replace_batch_in, write_stream_table

from conftest import SF_DIR


def test_stream_table_resumes_from_its_checkpoint(spark, table, tmp_path):
    spark.range(5).write.saveAsTable(f"{table}_src")
    for expected in (5, 5, 8):
        if expected == 8:
            spark.range(3).write.mode("append").saveAsTable(f"{table}_src")
        source = read_stream_table(spark, f"{table}_src")
        write_stream_table(source, table, str(tmp_path / "cp"), None).awaitTermination()
        assert spark.read.table(table).count() == expected


def test_export_skips_empty_batches_and_sees_each_row_once(spark, table, tmp_path):
    spark.range(4).write.saveAsTable(table)
    calls = []

    def remember(rows, batch_id):
        calls.append((batch_id, rows.count()))

    kept = read_stream_table(spark, table).filter("id < 100")
    export_stream(kept, remember, str(tmp_path / "cp"), None).awaitTermination()
    assert calls == [(0, 4)]
    export_stream(kept, remember, str(tmp_path / "cp"), None).awaitTermination()
    assert calls == [(0, 4)]
    spark.range(100, 103).write.mode("append").saveAsTable(table)
    export_stream(kept, remember, str(tmp_path / "cp"), None).awaitTermination()
    assert calls == [(0, 4)]  # a batch came, but with no row left in it
    spark.range(7, 9).write.mode("append").saveAsTable(table)
    export_stream(kept, remember, str(tmp_path / "cp"), None).awaitTermination()
    assert calls[1:] == [(2, 2)]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    write = replace_batch_in(str(tmp_path / "out"))
    write(spark.range(5), 0)
    write(spark.range(5), 0)
    write(spark.range(2), 1)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 7


def test_append_to_any_format(spark, tmp_path):
    write = append_to("json", path=str(tmp_path / "out"))
    write(spark.range(2), 0)
    write(spark.range(3), 1)
    assert spark.read.json(str(tmp_path / "out")).count() == 5


def test_envelope_files_through_all_hops(spark, table, tmp_path):
    landing = str(tmp_path / "landing")
    feed.messages(feed.read_events(spark, SF_DIR)).write.parquet(landing)
    ingest(read_envelope_files(spark, landing), f"{table}_raw", str(tmp_path / "c1"), None).awaitTermination()
    refine(spark, f"{table}_raw", table, str(tmp_path / "c2"), None).awaitTermination()
    out = str(tmp_path / "out")
    export(spark, table, replace_batch_in(out), str(tmp_path / "c3"), None).awaitTermination()
    raw, clean = spark.read.table(f"{table}_raw"), spark.read.table(table)
    assert raw.count() > clean.count() == spark.read.parquet(out).count() > 0
    assert len(raw.columns) == 10 and len(clean.columns) == 28
    assert clean.select("event_id").distinct().count() == clean.count()


@pytest.mark.parametrize("rules_at", ["before_dedup", "after_dedup"])
def test_stream_of_many_batches_equals_the_batch(spark, play, rules_at):
    """Rows in order of event time, so that none is late: same rows either way."""
    bronze = to_bronze(feed.messages(feed.read_events(spark, SF_DIR)))
    weeks = F.weekofyear("kafka_timestamp")
    parts = [bronze.filter(weeks == w).orderBy("kafka_timestamp", "kafka_offset") for w in range(1, 6)]
    out, progress = play(parts, lambda s: clean(s, rules_at=rules_at, watch="rules"))
    columns = [c for c in out.columns if c not in ("silver_processed_ts", "bronze_ingestion_ts", "risk_signals")]
    want = clean(bronze, rules_at=rules_at)
    assert want.select(columns).exceptAll(out.select(columns)).count() == 0
    assert out.count() == want.count() > 0
    seen = [p["observedMetrics"]["rules"] for p in progress if p["numInputRows"]]
    assert len(seen) == 5
    kept = sum(s["rows"] for s in seen) - out.count()
    assert kept >= sum(max(s["valid_event_id"], s["valid_amount"]) for s in seen) > 0


def test_catch_up_twice_takes_only_what_is_new(spark, table):
    root = scratch_path(spark, "catch-up-test")
    landing = f"{root}/landing"
    events = feed.messages(feed.read_events(spark, SF_DIR))
    half = F.col("timestamp") < "2024-01-16"
    names = {name: f"{table}_{name}" for name in TABLES}
    counts = []
    for part in (events.filter(half), events.filter(~half)):
        part.write.mode("append").parquet(landing)
        catch_up(spark, read_envelope_files(spark, landing), root, names)
        counts.append(spark.read.table(names["transactions_clean"]).count())
        days = spark.read.table(names["daily_kpis"])
        assert days.agg(F.sum("transaction_count")).first()[0] == counts[-1]
    assert 0 < counts[0] < counts[1]
    for name, spec in TABLES.items():
        assert spark.catalog.getTable(names[name]).description == spec.comment


def test_refresh_replaces_and_describes(spark, table):
    refresh_view(spark.range(5), table, "It's a view")
    refresh_view(spark.range(2), table, "It's a view")
    assert spark.read.table(table).count() == 2
    assert spark.catalog.getTable(table).description == "It's a view"


def test_refresh_keeps_the_newest_tables_and_may_read_itself(spark, table):
    behind = [refresh_view(spark.range(1), table)]
    for _ in range(3):
        twice = spark.read.table(table).union(spark.read.table(table))
        behind.append(refresh_view(twice, table))
    assert spark.read.table(table).count() == 8
    assert [spark.catalog.tableExists(t) for t in behind] == [False, False, True, True]


def test_a_failed_refresh_leaves_the_old_result(spark, table):
    refresh_view(spark.range(5), table)
    with pytest.raises(Exception):
        refresh_view(spark.range(5).selectExpr("raise_error('no') AS id"), table)
    assert spark.read.table(table).count() == 5


def test_views_refresh_under_their_declared_names(spark):
    clean(to_bronze(feed.messages(feed.read_events(spark, SF_DIR)))).write.saveAsTable("transactions_clean")
    refresh_views(spark)
    for name, spec in TABLES.items():
        if spec.kind == "view":
            assert spark.read.table(name).count() > 0


def test_scratch_paths_are_shared_and_fresh(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two
    assert one.startswith(shared)


def test_a_dropped_version_takes_its_files_along(spark, table, tmp_path):
    root = tmp_path / "root"
    for k in range(4):
        refresh_view(spark.range(k + 1), table, root=str(root))
    assert len([p for p in root.iterdir() if p.is_dir()]) == 2
    assert spark.read.table(table).count() == 4


def test_an_interval_runs_until_it_is_stopped(spark, table, tmp_path):
    spark.range(5).write.saveAsTable(f"{table}_src")
    source = read_stream_table(spark, f"{table}_src")
    query = write_stream_table(source, table, str(tmp_path / "cp"), interval="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive and spark.read.table(table).count() == 5
        spark.range(3).write.mode("append").saveAsTable(f"{table}_src")
        query.processAllAvailable()
        spark.catalog.refreshTable(table)
        assert spark.read.table(table).count() == 8
    finally:
        query.stop()
    assert not query.isActive
