"""Increments of the customer activity table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from txrisk.operators.merge import merge_by_key, newer_rows
from txrisk.plans.incremental import activity_of, apply_fold, apply_increment, customer_activity, fold, increment

SILVER = "customer_id bigint, amount double, country string, merchant_category string, is_suspicious_hint boolean, event_ts string"
DAY1 = [
    (1, 10.0, "US", "fuel", True, "2024-01-01 10:00:00"),
    (1, 20.0, "GB", "fuel", None, "2024-01-01 11:00:00"),
    (2, 5.0, "US", "travel", False, "2024-01-01 12:00:00"),
    (None, 1.0, "US", "fuel", True, "2024-01-01 09:00:00"),
    (3, 7.0, None, None, None, None),
]
DAY2 = [
    (1, 100.0, "SE", "luxury", True, "2024-01-02 10:00:00"),
    (4, 2.5, "US", "fuel", False, "2024-01-02 11:00:00"),
    (2, 50.0, "DE", "fuel", True, "2024-01-01 12:00:00"),  # tied with the mark
    (3, 9.0, "US", "fuel", True, None),  # no event time
    (None, 3.0, "GB", "fuel", True, "2024-01-02 12:00:00"),
]


def silver(spark, rows):
    df = spark.createDataFrame(rows, SILVER)
    return df.withColumn("event_ts", F.col("event_ts").cast("timestamp"))


def figures(df):
    """customer -> (count, total, average, max, suspicious, countries, categories), sorted."""
    cols = [c for c in df.columns if not c.endswith("_ts")]
    return sorted((tuple(r) for r in df.select(cols).collect()), key=str)


FIRST = [
    (1, 2, 30.0, 15.0, 20.0, 1, 2, 1),
    (2, 1, 5.0, 5.0, 5.0, 0, 1, 1),
    (3, 1, 7.0, 7.0, 7.0, 0, 0, 0),
    (None, 1, 1.0, 1.0, 1.0, 1, 1, 1),
]


def test_first_run_covers_everyone(spark):
    got = increment(silver(spark, DAY1), None)
    assert got.columns == [
        "customer_id", "transaction_count", "total_amount", "avg_amount", "max_amount",
        "suspicious_transaction_count", "countries_used", "merchant_categories_used",
        "last_event_ts", "dbt_processed_ts",
    ]
    assert figures(got) == FIRST


def test_replace_holds_the_last_increment_only(spark):
    target = increment(silver(spark, DAY1), None)
    got = increment(silver(spark, DAY1 + DAY2), target, "replace")
    assert figures(got) == sorted(
        [
            (1, 1, 100.0, 100.0, 100.0, 1, 1, 1),
            FIRST[1],  # the tied row is not newer
            FIRST[2],  # nor is one without event time
            FIRST[3],  # a null key matches nothing ...
            (None, 1, 3.0, 3.0, 3.0, 1, 1, 1),  # ... so null-keyed rows pile up
            (4, 1, 2.5, 2.5, 2.5, 0, 1, 1),
        ],
        key=str,
    )


def test_recompute_covers_the_history_of_changed_customers(spark):
    target = increment(silver(spark, DAY1), None)
    got = increment(silver(spark, DAY1 + DAY2), target, "recompute")
    assert (1, 3, 130.0, 43.33, 100.0, 2, 3, 2) in figures(got)
    assert FIRST[1] in figures(got)  # late row waits for a newer one
    assert (4, 1, 2.5, 2.5, 2.5, 0, 1, 1) in figures(got)
    assert [r for r in figures(got) if r[0] is None] == [(None, 2, 4.0, 2.0, 3.0, 2, 2, 1)]
    assert len(figures(got)) == 5


def test_recompute_equals_a_full_run_when_rows_come_in_order(spark):
    rows = [(i % 7, i / 4, f"c{i % 3}", f"m{i % 5}", i % 2 == 0, f"2024-01-01 00:{i:02d}:00") for i in range(60)]
    target = increment(silver(spark, rows[:40]), None)
    got = increment(silver(spark, rows), target, "recompute")
    assert figures(got) == figures(customer_activity(silver(spark, rows)))


def test_nothing_new_changes_nothing(spark):
    target = increment(silver(spark, DAY1), None)
    for mode in ("replace", "recompute"):
        assert figures(increment(silver(spark, DAY1), target, mode)) == FIRST


def test_empty_target_takes_everything_with_an_event_time(spark):
    empty = increment(silver(spark, DAY1), None).filter("false")
    assert newer_rows(silver(spark, DAY1), empty).count() == 4


def test_unknown_mode(spark):
    target = increment(silver(spark, DAY1), None)
    with pytest.raises(ValueError, match="mode"):
        increment(silver(spark, DAY1), target, "append")


def test_distinct_counts_and_fallback_money_survive_the_two_steps(spark):
    rows = [
        (1, 0.333333, "US", "a", None, "2024-01-01 00:00:00"),
        (1, 0.01, "US", "b", None, "2024-01-01 00:00:00"),
        (1, None, "GB", None, None, "2024-01-01 00:00:00"),
        (2, 9e14, "US", "a", None, "2024-01-01 00:00:00"),
        (2, 9e14, "US", "a", None, "2024-01-01 00:00:00"),
        (2, 1.0, "US", "b", None, "2024-01-01 00:00:00"),
    ]
    assert figures(customer_activity(silver(spark, rows))) == [
        (1, 3, 0.34, 0.17, 0.33, 0, 2, 2),
        (2, 3, 1.8e15 + 1, 600000000000000.33, 9e14, 0, 1, 2),
    ]


def test_merge_keeps_column_order_whatever_the_changes_have(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    changes = spark.createDataFrame([("new", 2), ("new", 3)], "v string, k int")
    got = merge_by_key(target, changes, "k")
    assert got.columns == ["k", "v"]
    assert sorted(map(tuple, got.collect())) == [(1, "old"), (2, "new"), (3, "new")]


def test_apply_increment_switches_a_view(spark, table):
    source = f"{table}_clean"
    silver(spark, DAY1).write.saveAsTable(source)
    first = apply_increment(spark, source, table)
    assert figures(spark.read.table(table)) == FIRST
    silver(spark, DAY2).write.mode("append").saveAsTable(source)
    second = apply_increment(spark, source, table, "recompute")
    assert (1, 3, 130.0, 43.33, 100.0, 2, 3, 2) in figures(spark.read.table(table))
    third = apply_increment(spark, source, table, "recompute")
    names = {r.tableName for r in spark.sql(f"SHOW TABLES LIKE '{table}__*'").collect()}
    assert names == {second, third}
    assert first not in names


def test_bucketed_targets_are_not_shuffled_again(spark, table):
    source = f"{table}_clean"
    silver(spark, DAY1).write.saveAsTable(source)
    apply_increment(spark, source, table, buckets=4)
    silver(spark, DAY2).write.mode("append").saveAsTable(source)
    merged = increment(spark.read.table(source), spark.read.table(table), "replace")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan[plan.index("SortMergeJoin") :]
    target_side = join[: join.index("Bucketed: true")]
    assert "Exchange" not in target_side
    apply_increment(spark, source, table, "recompute", buckets=4)
    assert (1, 3, 130.0, 43.33, 100.0, 2, 3, 2) in figures(spark.read.table(table))


def test_a_failed_increment_leaves_the_old_state(spark, table):
    source = f"{table}_clean"
    silver(spark, DAY1).write.saveAsTable(source)
    apply_increment(spark, source, table)
    with pytest.raises(Exception):
        apply_increment(spark, source, table, "nonsense")
    assert figures(spark.read.table(table)) == FIRST


def test_folding_equals_a_full_run_with_late_and_tied_rows(spark, table):
    source, seen = f"{table}_clean", []
    late = [(1, 3.0, "NO", "fuel", True, "2023-12-01 00:00:00"), (9, 0.125, None, None, None, None)]
    for rows in (DAY1, DAY2, late, DAY1):
        seen += rows
        part = silver(spark, rows).withColumn("silver_processed_ts", F.current_timestamp())
        part.write.mode("append").saveAsTable(source)
        apply_fold(spark, source, table)
        apply_fold(spark, source, table)  # nothing new: nothing changes
        got = figures(activity_of(spark.read.table(table)))
        assert got == figures(customer_activity(silver(spark, seen)))


def test_a_fold_reads_only_what_arrived_since(spark, tmp_path):
    stamped = silver(spark, DAY1).withColumn("silver_processed_ts", F.current_timestamp())
    stamped.write.parquet(str(tmp_path / "clean"))
    clean = spark.read.parquet(str(tmp_path / "clean"))
    fold(clean, None).write.parquet(str(tmp_path / "cells"))
    df = fold(clean, spark.read.parquet(str(tmp_path / "cells")))
    scans = [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x]
    (history,) = [x for x in scans if "silver_processed_ts" in x.split("Batched")[0]]
    assert "silver_processed_ts" in history.split("DataFilters")[1] and ">" in history
