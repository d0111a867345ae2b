"""Two memories of ids: state for the watermark's delay, a table for ever."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Observation
from pyspark.sql import functions as F

from txrisk.operators.dedup import first_arrivals_stream
from txrisk.session import complete_folders, use_disk_backed_state
from txrisk.sources.tables import read_stream_table
from txrisk.streaming.tiers import BUCKETS, apply_tier, read_tiers, remembered, unknown

IDS_IN_TIME = ["CAST(id AS STRING) AS event_id", "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, id) AS event_ts"]
DDL = "event_id string, event_ts timestamp, n int"


def deliveries(spark, steps: int = 8):
    """Thirty ids a step, an hour on; copies of ids of every step before, with times of
    their own step, and late rows."""
    for step in range(steps):
        at = f"timestamp'2024-01-01' + make_interval(0, 0, 0, 0, {step}, id % 60)"
        new = spark.range(30).selectExpr(f"concat('{step}-', id) AS event_id", f"{at} AS event_ts", f"{step} AS n")
        again = spark.range(step * 4).selectExpr(
            f"concat(id % {max(step, 1)}, '-', id) AS event_id", f"{at} AS event_ts", f"{step} AS n"
        )
        late = spark.range(3).selectExpr(
            f"concat('late-{step}-', id) AS event_id", "timestamp'2023-12-31' AS event_ts", f"{step} AS n"
        )
        untimed = spark.range(2).selectExpr("concat('untimed-', id) AS event_id", "CAST(NULL AS TIMESTAMP) AS event_ts", f"{step} AS n")
        yield new.union(again).union(late).union(untimed)


def test_eight_deliveries_as_if_remembered_for_ever(spark, table, tmp_path):
    root, kept = str(tmp_path / "tiers"), str(tmp_path / "for-ever")
    states, longer = [], []
    for rows in deliveries(spark):
        rows.coalesce(1).write.mode("append").saveAsTable(table)
        for retention, seen in (("within_watermark", states), ("forever", longer)):
            stream = first_arrivals_stream(read_stream_table(spark, table), retention=retention)
            checkpoint = str(tmp_path / f"checkpoint-{retention}")
            writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
            if retention == "forever":
                query = writer.format("parquet").option("path", kept).start()
            else:
                query = writer.foreachBatch(lambda b, n: apply_tier(b, n, root, buckets=4, fold_every=3)).start()
            query.awaitTermination()
            seen.append(remembered(spark, checkpoint).count())
    got = sorted(r.event_id for r in read_tiers(spark, root).collect())
    want = sorted(r.event_id for r in spark.read.parquet(kept).collect())
    assert got == want and len(got) == len(set(got)) == 8 * 30 + 3 + 2
    assert max(states) < 80 and longer[-1] == len(want)  # a delivery or two, and not the history
    assert complete_folders(spark, root)["folded"][0] >= 5


def test_a_stream_run_once_leaves_no_changes_to_replay(spark, table, tmp_path):
    """It uploads its state, and goes on from the changes that a running one uploaded."""
    checkpoint = f"{tmp_path}/checkpoint"

    def deliver(first: int, last: int, once: bool):
        rows = spark.range(first, last).selectExpr(*IDS_IN_TIME)
        rows.write.format("parquet").mode("append").option("path", f"{tmp_path}/in").saveAsTable(table)
        use_disk_backed_state(spark, once)
        stream = first_arrivals_stream(read_stream_table(spark, table))
        writer = stream.writeStream.option("checkpointLocation", checkpoint).format("noop")
        writer.trigger(availableNow=True).start().awaitTermination()
        return {p.name for p in Path(checkpoint).glob("state/**/*.changelog")}

    names = ["providerClass", "rocksdb.changelogCheckpointing.enabled", "rocksdb.trackTotalNumberOfRows"]
    names = [f"spark.sql.streaming.stateStore.{name}" for name in names]
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        changes = deliver(0, 20, once=False)
        assert changes
        assert deliver(10, 40, once=True) == changes
        assert list(Path(checkpoint).glob("state/**/*.zip"))
        assert remembered(spark, checkpoint).count() == 40
    finally:  # other tests count the rows in state
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def ids(spark, first: int, last: int):
    return spark.range(first, last).selectExpr("CAST(id AS STRING) AS event_id", "CAST(NULL AS TIMESTAMP) AS event_ts", "0 AS n")


def test_a_batch_handed_over_again_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "tiers")
    for n in range(7):
        for _ in range(2):
            apply_tier(ids(spark, n * 10, n * 10 + 20), n, root, 4, 3)
    rows = read_tiers(spark, root)
    assert rows.count() == rows.distinct().count() == 80


def test_a_batch_is_taken_once_and_written_once(spark, tmp_path):
    """Its rows lie nowhere else on the way, and a stream's state is run even for a batch
    that is there already."""
    root = str(tmp_path / "tiers")
    for n, first in ((0, 0), (1, 10), (1, 10)):
        taken = Observation()
        rows = ids(spark, first, first + 20).observe(taken, F.count(F.lit(1)).alias("rows"))
        apply_tier(rows, n, root, 4, 8)
        assert taken.get["rows"] == 20
    assert {p.name for p in Path(root).iterdir()} == {"rows"}
    assert sorted(int(r.event_id) for r in read_tiers(spark, root).collect()) == list(range(30))


def test_a_failure_between_ids_and_their_mark(spark, tmp_path, monkeypatch):
    """The ids are there, the mark is not: they are added again, and no row is lost."""
    root = str(tmp_path / "tiers")
    for n in range(2):
        apply_tier(ids(spark, n * 10, n * 10 + 20), n, root, 4, 3)

    def fail(*_):
        raise OSError("no space")

    with monkeypatch.context() as broken:
        broken.setattr("txrisk.streaming.tiers.mark_complete", fail)
        try:
            apply_tier(ids(spark, 20, 40), 2, root, 4, 3)
        except OSError:
            pass
    assert "folded" not in complete_folders(spark, root)
    apply_tier(ids(spark, 20, 40), 2, root, 4, 3)
    apply_tier(ids(spark, 0, 50), 3, root, 4, 3)
    assert complete_folders(spark, root)["folded"] == [2]
    got = [int(r.event_id) for r in read_tiers(spark, root).collect()]
    assert sorted(got) == list(range(50))


def test_no_rows_at_all(spark, tmp_path):
    root = str(tmp_path / "tiers")
    assert read_tiers(spark, root) is None
    for n in range(4):
        apply_tier(ids(spark, 0, 0), n, root, 4, 2)
    assert read_tiers(spark, root).count() == 0


def test_ids_of_the_table_are_not_moved(spark, tmp_path):
    """Dealt by bucket already: only the batch's rows are shuffled, and of the table the
    id alone is read."""
    root = str(tmp_path / "tiers")
    apply_tier(ids(spark, 0, 2000), 0, root, BUCKETS, 1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = unknown(ids(spark, 1000, 3000), root, 1)
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert new.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Bucketed: true" in plan
    assert "ReadSchema: struct<event_id:string>" in plan


def test_ids_of_the_table_stay_whatever_the_batch_comes_in(spark, tmp_path):
    """Rows that come in more partitions than there are buckets, as a stream's may."""
    root = str(tmp_path / "tiers")
    apply_tier(ids(spark, 0, 200), 0, root, 4, 1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = unknown(ids(spark, 100, 300).repartition(16, "event_id"), root, 1, 4)
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert new.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Bucketed: true" in plan


def test_folding_writes_what_is_new_only(spark, tmp_path):
    root = str(tmp_path / "tiers")
    for n in range(2):
        apply_tier(ids(spark, n * 100, n * 100 + 100), n, root, 4, 2)
    first = {p: p.stat().st_mtime_ns for p in Path(root, "ids").glob("*.parquet")}
    for n in range(2, 4):
        apply_tier(ids(spark, n * 100, n * 100 + 100), n, root, 4, 2)
    after = {p: p.stat().st_mtime_ns for p in Path(root, "ids").glob("*.parquet")}
    assert first.items() <= after.items() and len(after) > len(first) > 0
    assert spark.read.parquet(f"{root}/ids").agg(F.count_distinct("event_id")).first()[0] == 400
