"""The physical plans: what must be in them, and what must not, at any scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from catalogue.queries import QUERIES
from txrisk.operators.bronze import to_bronze
from txrisk.operators.merge import newer_rows
from txrisk.operators.parse import to_typed
from txrisk.operators.rules import expect_or_drop
from txrisk.plans import gold
from txrisk.plans.incremental import customer_activity, increment
from txrisk.plans.silver import clean
from txrisk.schema import ENVELOPE_DDL

from conftest import SF_DIR


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    """A written clean table with every third row on one customer."""
    path = str(tmp_path_factory.mktemp("silver") / "t")
    hot = F.when(F.col("kafka_offset") % 3 == 0, F.lit(1)).otherwise(F.col("customer_id"))
    clean(QUERIES_BRONZE(spark)).withColumn("customer_id", hot).write.parquet(path)
    return spark.read.parquet(path)


def QUERIES_BRONZE(spark):
    from catalogue import feed

    return to_bronze(feed.messages(feed.read_events(spark, SF_DIR)))


@pytest.mark.parametrize("name", QUERIES)
def test_no_cross_joins_and_no_python_in_tasks(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for banned in ("CartesianProduct", "BroadcastNestedLoop", "Python", "Pandas", "ArrowEval"):
        assert banned not in text


def test_text_is_parsed_once_however_many_rules(spark):
    text = plan(expect_or_drop(to_typed(QUERIES_BRONZE(spark))))
    assert text.count("from_json") == 1


def test_batch_dedup_keeps_one_row_per_key_before_the_shuffle(spark):
    text = plan(clean(QUERIES_BRONZE(spark)))
    partial, exchange = text.index("1, Partial"), text.index("Exchange hashpartitioning(event_id")
    assert text.index("1, Final") < exchange < partial


def test_raw_and_typed_layers_do_not_shuffle(spark, tmp_path):
    envelopes = spark.createDataFrame([], ENVELOPE_DDL)
    assert "Exchange" not in plan(expect_or_drop(to_typed(to_bronze(envelopes))))


@pytest.mark.parametrize(
    "summary", [gold.customer_risk_summary, gold.merchant_risk_summary, gold.daily_kpis]
)
def test_summaries_combine_before_one_shuffle_and_read_few_columns(silver, summary):
    text = plan(summary(silver))
    assert text.count("Exchange") == 1
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text
    assert "ObjectHashAggregate" not in text
    read = re.search(r"ReadSchema: struct<([^>]*)", text).group(1)
    assert "device_id" not in text and read.count(":") <= 9


def test_activity_combines_rows_before_they_are_expanded(silver):
    text = plan(customer_activity(silver))
    rows_first = text.rindex("partial_count")
    assert text.index("Expand") < rows_first
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_high_water_mark_reaches_the_scan(silver):
    target = customer_activity(silver)
    assert "GreaterThan(event_ts,ScalarSubquery" in plan_formatted(newer_rows(silver, target))


def plan_formatted(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("mode", ["replace", "recompute"])
def test_increment_reads_the_transactions_once(spark, silver, mode, tmp_path):
    increment(silver.filter("event_ts < '2024-01-16'"), None).write.parquet(str(tmp_path / "t"))
    text = plan(increment(silver, spark.read.parquet(str(tmp_path / "t")), mode))
    assert text.count("FileScan parquet [customer_id") == 2  # transactions and target
    assert text.count("FullOuter") == 1


def test_hot_customer_changes_nothing(spark, silver):
    """Whole results under skew, against a plain computation."""
    got = gold.customer_risk_summary(silver).filter("customer_id = 1").first()
    want = silver.filter("customer_id = 1").agg(
        F.count("*"), F.round(F.sum(F.col("amount").cast("decimal(20,4)")), 2).cast("double")
    )
    assert (got.transaction_count, got.total_amount) == tuple(want.first())
    assert got.transaction_count >= silver.count() // 3


def test_flood_of_one_id(spark):
    """A third of all messages are copies of one event: one row of it is left,
    the first to arrive, and every other event is still there."""
    bronze = QUERIES_BRONZE(spark).filter("kafka_key IS NOT NULL")
    original = bronze.filter("kafka_key = 'txn-1'")
    copies = bronze.count() // 2
    flood = (
        spark.range(5_000_000_000, 5_000_000_000 + copies, numPartitions=7)
        .join(original.drop("kafka_offset"))
        .select(*[F.col("id").alias(c) if c == "kafka_offset" else F.col(c) for c in bronze.columns])
    )
    got = clean(bronze.unionByName(flood))
    want = clean(bronze)
    assert got.filter("event_id = '1'").select("kafka_offset").collect() == [(3_000_000_000,)]
    assert got.select("event_id", "kafka_offset").exceptAll(want.select("event_id", "kafka_offset")).count() == 0
    assert got.count() == want.count()
