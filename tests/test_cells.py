"""Summaries kept as cells, and upserts by bucket."""

from __future__ import annotations

import hashlib
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from txrisk.operators.merge import BUCKET, read_buckets, upsert_buckets
from txrisk.plans.cells import apply_batch, applied_folders, read_summary
from txrisk.plans.gold import customer_risk_summary, daily_kpis, merchant_risk_summary
from txrisk.plans.incremental import customer_activity
from txrisk.streaming.hops import keep_cells

FULL = {
    "customer_risk_summary": customer_risk_summary,
    "merchant_risk_summary": merchant_risk_summary,
    "daily_kpis": daily_kpis,
    "customer_activity": customer_activity,
}


def rows_of(spark, steps: int = 12):
    """Rows of all days in every step; clocks run backwards, and some values are null."""
    return spark.range(steps * 40).select(
        F.col("id").alias("event_id"),
        F.expr("if(id % 11 = 0, NULL, id % 7)").alias("customer_id"),
        (F.col("id") % 3).alias("merchant_id"),
        F.concat(F.lit("m"), F.col("id") % 2).alias("merchant_name"),
        F.expr("element_at(array('fuel', 'travel', NULL), CAST(id % 3 AS INT) + 1)").alias("merchant_category"),
        F.expr("if(id % 13 = 0, NULL, CAST(id AS DOUBLE) / 8 - 0.0049999999)").alias("amount"),
        F.expr("element_at(array('US', 'GB', 'SE', NULL), CAST(id % 4 AS INT) + 1)").alias("country"),
        F.expr("if(id % 7 = 3, NULL, id % 5 = 0)").alias("is_suspicious_hint"),
        F.expr("if(id % 17 = 0, NULL, timestamp'2024-01-01' + make_interval(0, 0, 0, id * 7 % 9))").alias("event_ts"),
        F.expr("timestamp'2024-02-01' - make_interval(0, 0, 0, 0, id)").alias("silver_processed_ts"),
    )


def same(got, want) -> bool:
    return sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_cells_of_twelve_batches_are_the_full_result(spark, tmp_path):
    rows, root = rows_of(spark), str(tmp_path / "cells")
    for step in range(12):
        part = rows.filter(f"event_id % 12 = {step}")
        apply_batch(part, step, root, fold_every=3)
        apply_batch(part, step, root, fold_every=3)  # handed over again
        assert all(len(applied_folders(spark, f"{root}/{name}")) <= 4 for name in FULL)
    for name, full in FULL.items():
        assert same(read_summary(spark, root, name), full(rows)), name
        # What was folded is gone, but for the fold that a reader may still be at.
        assert len([p for p in Path(root, name).iterdir() if p.name.startswith("base")]) <= 2
        assert len(list(Path(root, name).iterdir())) <= 9
    apply_batch(rows.filter("event_id % 12 = 2"), 2, root)  # folded long ago
    assert same(read_summary(spark, root, "daily_kpis"), daily_kpis(rows))


def test_a_batch_that_failed_half_way_is_written_again(spark, tmp_path):
    rows, root = rows_of(spark, 3), str(tmp_path / "cells")
    names = ["daily_kpis"]
    apply_batch(rows.filter("event_id % 2 = 0"), 0, root, names)
    apply_batch(rows, 1, root, names)  # other rows, and not complete
    (tmp_path / "cells" / "daily_kpis" / "batch=1" / "_SUCCESS").unlink()
    assert same(read_summary(spark, root, "daily_kpis"), daily_kpis(rows.filter("event_id % 2 = 0")))
    apply_batch(rows.filter("event_id % 2 = 1"), 1, root, names)
    assert same(read_summary(spark, root, "daily_kpis"), daily_kpis(rows))


def test_a_fold_that_failed_half_way_counts_for_nothing(spark, tmp_path):
    rows, root = rows_of(spark, 3), str(tmp_path / "cells")
    folder = tmp_path / "cells" / "daily_kpis"
    for step in range(3):
        apply_batch(rows.filter(f"event_id % 3 = {step}"), step, root, ["daily_kpis"])
    shutil.copytree(folder / "batch=2", folder / "base=2")
    (folder / "base=2" / "_SUCCESS").unlink()
    assert same(read_summary(spark, root, "daily_kpis"), daily_kpis(rows))
    apply_batch(rows.limit(0), 3, root, ["daily_kpis"], fold_every=2)
    assert applied_folders(spark, str(folder)) == [f"{folder}/base=3"]
    assert same(read_summary(spark, root, "daily_kpis"), daily_kpis(rows))


def test_a_trigger_reads_what_is_new(spark, tmp_path, table):
    rows, root, path = rows_of(spark, 6), str(tmp_path / "cells"), str(tmp_path / "clean")
    for step in range(3):
        part = rows.filter(f"event_id % 3 = {step}")
        part.write.format("parquet").mode("append").option("path", path).saveAsTable(table)
        query = keep_cells(spark, table, str(tmp_path / "checkpoint"), root, interval=None)
        query.awaitTermination()
        # Each of the four summaries, and the test for emptiness, may read the batch.
        assert sum(p.numInputRows for p in query.recentProgress) <= 80 * 5
    for name, full in FULL.items():
        assert same(read_summary(spark, root, name), full(rows)), name


def test_nothing_applied_is_no_summary(spark, tmp_path):
    assert read_summary(spark, str(tmp_path), "daily_kpis") is None


def files(path: Path) -> dict[str, str]:
    return {str(f): hashlib.sha256(f.read_bytes()).hexdigest() for f in path.rglob("*.parquet")}


@pytest.mark.parametrize("changed", [[3], [3, 4, 99, None]])
def test_an_upsert_writes_touched_buckets_only(spark, tmp_path, changed):
    path = tmp_path / "kept"
    first = spark.range(40).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    upsert_buckets(first, str(path), "k", 8)
    before = files(path)
    changes = spark.createDataFrame([(k, "new") for k in changed], "k bigint, v string")
    upsert_buckets(changes, str(path), "k", 8)
    got = sorted((str(r.k), r.v) for r in read_buckets(spark, str(path)).collect())
    want = {str(k): "old" for k in range(40)} | {str(k): "new" for k in changed}
    assert got == sorted(want.items())
    touched = {r[0] for r in changes.select(F.pmod(F.xxhash64("k"), F.lit(8))).collect()}
    kept = {f: h for f, h in before.items() if not any(f"{BUCKET}={b}/" in f for b in touched)}
    assert kept and kept.items() <= files(path).items()
    upsert_buckets(changes.filter("k IS NOT NULL"), str(path), "k", 8)  # given again
    assert sorted((str(r.k), r.v) for r in read_buckets(spark, str(path)).collect()) == sorted(want.items())
