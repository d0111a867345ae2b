"""Exact distinct counts by bitmaps over numbered values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_cells import rows_of, same

from txrisk.plans.cells import applied_folders, read_cells
from txrisk.plans.distinct import BITS, KEY, PART, apply_bitmaps, read_activity
from txrisk.plans.incremental import customer_activity
from txrisk.streaming.hops import keep_bitmaps


@pytest.mark.parametrize("spread", [1, 3])
def test_bitmaps_of_several_folds_are_the_full_result(spark, tmp_path, spread):
    rows, root = rows_of(spark), str(tmp_path / "bits")
    for step in range(12):
        part = rows.filter(f"event_id % 12 = {step}")
        apply_bitmaps(part, step, root, 3, spread)
        apply_bitmaps(part, step, root, 3, spread)  # handed over again
    assert same(read_activity(spark, root), customer_activity(rows))
    assert all(len(applied_folders(spark, f"{root}/{c}")) <= 4 for c in (KEY, "country", "merchant_category"))
    apply_bitmaps(rows.filter("event_id % 12 = 2"), 2, root, 3, spread)  # folded long ago
    assert same(read_activity(spark, root), customer_activity(rows))


def test_state_is_one_row_a_customer(spark, tmp_path):
    rows, root = rows_of(spark), str(tmp_path / "bits")
    for step in range(4):
        apply_bitmaps(rows, step, root, fold_every=1)
    cells = read_cells(spark, f"{root}/{KEY}")
    assert cells.count() == rows.select(KEY).distinct().count()


@pytest.mark.parametrize("spread", [1, 2])
def test_values_beyond_one_bitmap(spark, tmp_path, spread):
    """70,000 countries, of which a customer has all; half of them come in each batch."""
    many, root = 70_000, str(tmp_path / "bits")
    rows = spark.range(many).selectExpr(
        "id AS event_id", "if(id % 5 = 0, 1, 2) AS customer_id", "concat('c', id) AS country",
        "concat('m', id % 9) AS merchant_category", "CAST(1 AS DOUBLE) AS amount",
        "true AS is_suspicious_hint", "timestamp'2024-01-01' AS event_ts",
    )
    for step in range(2):
        apply_bitmaps(rows.filter(f"event_id % 2 = {step}"), step, root, spread=spread)
    ids = read_cells(spark, f"{root}/country")
    least, most, different = ids.agg(F.min("id"), F.max("id"), F.count_distinct("id")).first()
    assert different == many and least == 1
    assert most == many if spread == 1 else most <= 4 * BITS  # two bitmaps a slot
    assert same(read_activity(spark, root), customer_activity(rows))
    assert read_cells(spark, f"{root}/{KEY}").select(PART).distinct().count() >= 3


def test_numbers_stand_when_the_bitmaps_failed(spark, tmp_path):
    rows, root = rows_of(spark, 3), str(tmp_path / "bits")
    early, late = rows.filter("event_id < 60"), rows.filter("event_id >= 60")
    apply_bitmaps(early, 0, root)
    apply_bitmaps(late, 1, root)
    before = sorted(read_cells(spark, f"{root}/country").collect())
    (tmp_path / "bits" / KEY / "batch=1" / "_SUCCESS").unlink()
    assert same(read_activity(spark, root), customer_activity(early))
    apply_bitmaps(late, 1, root)
    assert sorted(read_cells(spark, f"{root}/country").collect()) == before
    assert same(read_activity(spark, root), customer_activity(rows))


def test_nothing_but_nulls(spark, tmp_path):
    root = str(tmp_path / "bits")
    assert read_activity(spark, root) is None
    rows = rows_of(spark, 1).withColumns({"country": F.lit(None).cast("string"), "merchant_category": F.lit(None).cast("string")})
    apply_bitmaps(rows.limit(0), 0, root)
    assert read_activity(spark, root).count() == 0
    apply_bitmaps(rows, 1, root)
    assert same(read_activity(spark, root), customer_activity(rows))


def test_a_stream_keeps_bitmaps(spark, tmp_path, table):
    rows, path = rows_of(spark, 6), str(tmp_path / "clean")
    for step in range(3):
        part = rows.filter(f"event_id % 3 = {step}")
        part.write.format("parquet").mode("append").option("path", path).saveAsTable(table)
        root, checkpoint = str(tmp_path / "bits"), str(tmp_path / "checkpoint")
        query = keep_bitmaps(spark, table, checkpoint, root, interval=None, fold_every=2)
        query.awaitTermination()
        # Numbers of two columns, the bitmaps, and the test for emptiness may read the batch.
        assert sum(p.numInputRows for p in query.recentProgress) <= 80 * 4
    assert same(read_activity(spark, str(tmp_path / "bits")), customer_activity(rows))
