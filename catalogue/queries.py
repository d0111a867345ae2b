"""Every registered query, as ``(spark, sf_dir) -> DataFrame``.

All of them read the whole ``events`` table, turned into a feed of messages by
:mod:`catalogue.feed`. Columns that hold the time of the run are left out, and
timestamps are given without a zone, so that results can be compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from catalogue import feed
from txrisk.functions import measures as m
from txrisk.functions.risk import is_suspicious, risk_score, risk_signals, signal_columns
from txrisk.functions.scalars import is_cross_border, is_high_amount
from txrisk.operators.bronze import to_bronze
from txrisk.operators.merge import newer_rows, read_buckets, upsert_buckets
from txrisk.operators.parse import fields, parse_payload, to_typed
from txrisk.operators.rules import expect_or_drop, rule_counts
from txrisk.plans import gold
from txrisk.plans.cells import read_summary
from txrisk.plans.days import DAY, read_days, with_day
from txrisk.plans.distinct import read_activity
from txrisk.plans.incremental import (
    activity_of,
    apply_fold,
    apply_increment,
    customer_activity,
    increment,
)
from txrisk.plans.silver import clean
from txrisk.plans.tables import TABLES, refresh_view
from txrisk.session import scratch_path
from txrisk.sources.messages import encode_messages
from txrisk.sources.tables import read_table
from txrisk.streaming import once
from txrisk.streaming.hops import (
    catch_up,
    export,
    ingest,
    keep_bitmaps,
    keep_cells,
    keep_days,
    keep_fresh,
    keep_sized,
    refine,
)
from txrisk.streaming.ledger import RuleLedger, rule_totals
from txrisk.streaming.sinks import append_to, replace_batch_in
from txrisk.streaming.tiers import read_tiers, refine_in_tiers, remembered

Query = Callable[[SparkSession, str], DataFrame]

SPLIT = "2024-01-16"
_RUN_TIMES = ["bronze_ingestion_ts", "silver_processed_ts", "dbt_processed_ts"]


def comparable(df: DataFrame) -> DataFrame:
    """Drop run times, take the zone off timestamps, lay maps out as columns."""
    df = df.drop(*_RUN_TIMES)
    columns = []
    for name, kind in df.dtypes:
        if kind == "timestamp":
            columns.append(F.col(name).cast("timestamp_ntz").alias(name))
        elif kind.startswith("map"):
            columns += [F.col(name)[signal].alias(signal) for signal in signal_columns()]
        else:
            columns.append(F.col(name))
    return df.select(*columns)


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze(feed.messages(feed.read_events(spark, sf_dir)))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(_bronze(spark, sf_dir))


def _transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.transactions(feed.read_events(spark, sf_dir))


# --- Raw and clean layers, as batches -----------------------------------------


def bronze_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_bronze(spark, sf_dir).drop("bronze_record_hash"))


def bronze_record_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(spark, sf_dir).select("kafka_offset", "bronze_record_hash")


def silver_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = to_typed(_bronze(spark, sf_dir))
    return comparable(typed.drop("is_high_amount_txn", "is_cross_border"))


def silver_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_payload(_bronze(spark, sf_dir), fields("amount", "country"), ["kafka_offset"])
    flags = {"is_high_amount_txn": is_high_amount(), "is_cross_border": is_cross_border()}
    return parsed.withColumns(flags).select("kafka_offset", "amount", "country", *flags)


def _ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields that the rules are about."""
    ddl = fields("event_id", "transaction_id", "amount")
    return parse_payload(_bronze(spark, sf_dir), ddl, ["kafka_offset"])


def silver_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = expect_or_drop(_ruled(spark, sf_dir))
    return valid.select("kafka_offset", "event_id", "transaction_id", "amount")


def rule_violation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_counts(_ruled(spark, sf_dir))


def silver_dedup_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_silver(spark, sf_dir))


def silver_dedup_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(clean(_bronze(spark, sf_dir), rules_at="after_dedup"))


# --- Summaries ----------------------------------------------------------------


def customer_risk_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(gold.customer_risk_summary(_silver(spark, sf_dir)))


def merchant_risk_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(gold.merchant_risk_summary(_silver(spark, sf_dir)))


def daily_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(gold.daily_kpis(_silver(spark, sf_dir)))


def customer_risk_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(customer_activity(_silver(spark, sf_dir)))


def suspicious_null_semantics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both suspicious counts, where every tenth customer has no hints at all."""
    hint = F.when(F.col("customer_id") % 10 != 0, F.col("is_suspicious_hint"))
    return gold.summarise(
        _silver(spark, sf_dir).withColumn("is_suspicious_hint", hint),
        ["customer_id"],
        {
            "transaction_count": m.rows(),
            "count_or_null": m.flagged_or_null("is_suspicious_hint"),
            "count_or_zero": m.flagged("is_suspicious_hint"),
        },
    )


def aggregate_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every aggregate measure side by side, per channel."""
    measures = {
        "row_count": m.rows(),
        "device_count": m.given("device_id"),
        "distinct_countries": m.distinct("country"),
        "total_amount": m.total("amount"),
        "avg_amount": m.mean("amount"),
        "max_amount": m.peak("amount"),
        "last_event_ts": m.latest("event_ts"),
        "suspicious_or_null": m.flagged_or_null("is_suspicious_hint"),
        "suspicious": m.flagged("is_suspicious_hint"),
    }
    return comparable(gold.summarise(_silver(spark, sf_dir), ["channel"], measures))


# --- Risk rules and messages --------------------------------------------------


def risk_signals_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _transactions(spark, sf_dir).withColumn("risk_signals", risk_signals())
    return comparable(rows.select("offset", "risk_signals"))


def risk_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _transactions(spark, sf_dir).select("offset", risk_signals().alias("risk_signals"))
    return rows.select("offset", risk_score().alias("risk_score_hint")).withColumn(
        "is_suspicious_hint", is_suspicious()
    )


def channel_nulling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _transactions(spark, sf_dir).select("offset", "channel", "device_id", "ip_address")


def message_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = feed.payload(feed.read_events(spark, sf_dir)).drop(*feed.ENVELOPE)
    text = encode_messages(sent).select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_json"),
    )
    back = parse_payload(text, carried=["kafka_key"])
    return comparable(back.withColumn("event_ts", F.try_to_timestamp("event_ts")))


# --- Tables and increments ----------------------------------------------------


def _table_name(name: str) -> str:
    return f"txrisk_{name}_{uuid.uuid4().hex[:12]}"


def _append(df: DataFrame, table: str, path: str, by: list[str] | None = None) -> None:
    writer = df.write.format("parquet").mode("append").option("path", path)
    (writer.partitionBy(*by) if by else writer).saveAsTable(table)


def _silver_table(spark: SparkSession, sf_dir: str) -> str:
    table = _table_name("clean")
    _append(_silver(spark, sf_dir), table, scratch_path(spark, "clean"))
    return table


def _silver_in_growths(spark: SparkSession, sf_dir: str, number: int) -> list[DataFrame]:
    """The clean table dealt by id into growths, each in a folder of its own: taking one
    does not read the others."""
    table, growth = _table_name("clean"), F.col("event_id").cast("bigint") % number
    silver = _silver(spark, sf_dir).withColumn("growth", growth)
    _append(silver, table, scratch_path(spark, "clean"), ["growth"])
    dealt = read_table(spark, table)
    return [dealt.filter(F.col("growth") == n).drop("growth") for n in range(number)]


def _before_split(silver: DataFrame) -> DataFrame:
    return increment(silver.filter(F.col("event_ts") < SPLIT), None)


def incremental_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = read_table(spark, _silver_table(spark, sf_dir))
    return comparable(increment(silver, _before_split(silver), "replace"))


def incremental_recompute(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = read_table(spark, _silver_table(spark, sf_dir))
    return comparable(increment(silver, _before_split(silver), "recompute"))


def incremental_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table behind a view, brought up to date twice: with the rows up to the
    split, then with all of them."""
    silver = read_table(spark, _silver_table(spark, sf_dir))
    source, target = _table_name("arriving"), _table_name("activity")
    path, root = scratch_path(spark, "arriving"), scratch_path(spark, "activity")
    _append(silver.filter(F.col("event_ts") < SPLIT), source, path)
    apply_increment(spark, source, target, "recompute", root=root)
    _append(silver.filter(F.col("event_ts") >= SPLIT), source, path)
    apply_increment(spark, source, target, "recompute", root=root)
    return comparable(read_table(spark, target))


def incremental_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three increments, each with rows of all times, folded into kept cells."""
    silver = read_table(spark, _silver_table(spark, sf_dir))
    source, state = _table_name("arriving"), _table_name("cells")
    path, root = scratch_path(spark, "arriving"), scratch_path(spark, "cells")
    for step in range(3):
        part = silver.filter(F.col("event_id").cast("bigint") % 3 == step)
        _append(part.withColumn("silver_processed_ts", F.current_timestamp()), source, path)
        apply_fold(spark, source, state, root)
    return comparable(activity_of(read_table(spark, state)))


def high_water_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = read_table(spark, _silver_table(spark, sf_dir))
    newer = newer_rows(silver, _before_split(silver))
    return comparable(newer.select("event_id", "customer_id", "amount", "event_ts"))


def view_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    view, spec = _table_name("view"), TABLES["customer_risk_summary"]
    result = spec.query(_silver(spark, sf_dir))
    refresh_view(result, view, spec.comment, scratch_path(spark, "view"))
    return comparable(read_table(spark, view))


# --- Streams ------------------------------------------------------------------


def _streamed_silver(spark: SparkSession, sf_dir: str, **cleaning: object) -> str:
    """Feed -> raw table -> clean table, each hop a stream; the clean table's name."""
    raw, out = _table_name("raw"), _table_name("clean")
    envelope = feed.messages(feed.stream_events(spark, sf_dir))
    ingest(
        envelope,
        raw,
        scratch_path(spark, "ingest-checkpoint"),
        interval=None,
        path=scratch_path(spark, "raw"),
    ).awaitTermination()
    refine(
        spark,
        raw,
        out,
        scratch_path(spark, "refine-checkpoint"),
        interval=None,
        sink={"path": scratch_path(spark, "clean")},
        **cleaning,
    ).awaitTermination()
    return out


def silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(read_table(spark, _streamed_silver(spark, sf_dir)))


def silver_stream_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _streamed_silver(spark, sf_dir, rules_at="after_dedup")
    return comparable(read_table(spark, table))


def silver_stream_within_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _streamed_silver(spark, sf_dir, retention="within_watermark")
    return comparable(read_table(spark, table))


def _delivered(
    spark: SparkSession,
    sf_dir: str,
    checkpoint: str | None = None,
    after: Callable[[int], None] = lambda step: None,
    **cleaning: object,
) -> tuple[str, list[StreamingQuery]]:
    """The raw table grows delivery by delivery, and the clean stream is started on
    its checkpoint again after each: the clean table's name, and the ended runs."""
    raw, out = _table_name("raw"), _table_name("clean")
    raw_path, clean_path = scratch_path(spark, "raw"), scratch_path(spark, "clean")
    checkpoint, runs = checkpoint or scratch_path(spark, "refine-checkpoint"), []
    sent = feed.messages_in_steps(feed.read_events(spark, sf_dir))
    for step in range(feed.STEPS):
        _append(to_bronze(sent.filter(F.col("step") == step).drop("step")), raw, raw_path)
        query = refine(
            spark, raw, out, checkpoint, interval=None, sink={"path": clean_path}, **cleaning
        )
        query.awaitTermination()
        runs.append(query)
        after(step)
    return out, runs


def _refined_in_steps(
    spark: SparkSession, sf_dir: str, **cleaning: object
) -> tuple[str, list[int]]:
    """The clean table's name, and how many rows each delivery lost for being late."""
    out, runs = _delivered(spark, sf_dir, **cleaning)
    operators = [[x for p in q.recentProgress for x in p["stateOperators"]] for q in runs]
    return out, [sum(x["numRowsDroppedByWatermark"] for x in xs) for xs in operators]


def silver_stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(read_table(spark, _refined_in_steps(spark, sf_dir)[0]))


def silver_stream_batches_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = _refined_in_steps(spark, sf_dir, retention="within_watermark")
    return comparable(read_table(spark, table))


def late_rows_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per delivery: rows of the clean stream lost for being late."""
    _, late = _refined_in_steps(spark, sf_dir)
    return spark.createDataFrame(list(enumerate(late)), "step int, late_rows bigint")


def export_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, out = _silver_table(spark, sf_dir), scratch_path(spark, "export")
    export(
        spark,
        source,
        replace_batch_in(out),
        scratch_path(spark, "export-checkpoint"),
        interval=None,
    ).awaitTermination()
    return comparable(spark.read.parquet(out).drop("batch_id"))


def export_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three micro-batches through a connector, one of them without rows."""
    silver = read_table(spark, _silver_table(spark, sf_dir))
    source, path = _table_name("exported"), scratch_path(spark, "exported")
    out, checkpoint = scratch_path(spark, "export"), scratch_path(spark, "export-checkpoint")
    early = F.col("event_ts") < SPLIT
    for part in (silver.filter(early), silver.limit(0), silver.filter(~early)):
        _append(part, source, path)
        writer = append_to("parquet", path=out)
        export(spark, source, writer, checkpoint, interval=None).awaitTermination()
    return comparable(spark.read.parquet(out))


def gold_kept_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily figures, refreshed by a stream after each growth of the clean table."""
    silver = read_table(spark, _silver_table(spark, sf_dir))
    source, path = _table_name("growing"), scratch_path(spark, "growing")
    names = {name: _table_name(name) for name in TABLES}
    checkpoint, root = scratch_path(spark, "fresh-checkpoint"), scratch_path(spark, "fresh")
    early = F.col("event_ts") < SPLIT
    for part in (silver.filter(early), silver.filter(~early)):
        _append(part, source, path)
        keep_fresh(spark, source, checkpoint, names, root, interval=None).awaitTermination()
    return comparable(read_table(spark, names["daily_kpis"]))


def _by_cells(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A summary after five growths of the clean table, each with rows of all days."""
    silver = read_table(spark, _silver_table(spark, sf_dir))
    source, path = _table_name("growing"), scratch_path(spark, "growing")
    checkpoint, root = scratch_path(spark, "cells-checkpoint"), scratch_path(spark, "cells")
    for step in range(5):
        _append(silver.filter(F.col("event_id").cast("bigint") % 5 == step), source, path)
        keep_cells(spark, source, checkpoint, root, [name], interval=None, fold_every=3).awaitTermination()
    return comparable(read_summary(spark, root, name))


def gold_by_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_cells(spark, sf_dir, "daily_kpis")


def merchants_by_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_cells(spark, sf_dir, "merchant_risk_summary")


def customers_by_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_cells(spark, sf_dir, "customer_risk_summary")


def activity_by_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct countries and categories, too, by cells of each."""
    return _by_cells(spark, sf_dir, "customer_activity")


def activity_by_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct countries and categories by bitmaps of each customer, after five growths."""
    silver = read_table(spark, _silver_table(spark, sf_dir))
    source, path = _table_name("growing"), scratch_path(spark, "growing")
    checkpoint, root = scratch_path(spark, "bitmaps-checkpoint"), scratch_path(spark, "bitmaps")
    for step in range(5):
        _append(silver.filter(F.col("event_id").cast("bigint") % 5 == step), source, path)
        keep_bitmaps(spark, source, checkpoint, root, interval=None, fold_every=3).awaitTermination()
    return comparable(read_activity(spark, root))


def silver_in_sized_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table in files of a wanted size, after six growths, each with rows of all
    days; every second one closes the days that are over, and most rows come late for these."""
    source, path = _table_name("growing"), scratch_path(spark, "growing")
    view, root = _table_name("sized"), scratch_path(spark, "sized")
    checkpoint = scratch_path(spark, "sized-checkpoint")
    for growth in _silver_in_growths(spark, sf_dir, 6):
        _append(growth, source, path)
        keep_sized(spark, source, checkpoint, view, root, None, close_every=2).awaitTermination()
    return comparable(read_table(spark, view).drop(DAY))


def activity_in_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' activity in a table in buckets, of which an upsert writes only those
    with changed customers: all rows up to the split, then the customers with later ones."""
    silver = read_table(spark, _silver_table(spark, sf_dir))
    path = scratch_path(spark, "buckets")
    upsert_buckets(customer_activity(silver.filter(F.col("event_ts") < SPLIT)), path, "customer_id", 16)
    newer = silver.filter(F.col("event_ts") >= SPLIT).select("customer_id").distinct()
    changed = silver.join(newer, "customer_id", "left_semi")
    upsert_buckets(customer_activity(changed), path, "customer_id", 16)
    return comparable(read_buckets(spark, path))


def gold_by_touched_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily figures, recomputed after each of three growths of a clean table in
    folders by day: the first half of the month, the second, and what came late for both."""
    silver = with_day(read_table(spark, _silver_table(spark, sf_dir)))
    source, path = _table_name("by_day"), scratch_path(spark, "by-day")
    checkpoint, out = scratch_path(spark, "days-checkpoint"), scratch_path(spark, "days")
    late = F.col("event_id").cast("bigint") % 7 == 0
    early = F.col("event_ts") < SPLIT
    for part in (silver.filter(~late & early), silver.filter(~late & ~early), silver.filter(late)):
        _append(part, source, path, [DAY])
        keep_days(spark, source, checkpoint, out, interval=None).awaitTermination()
    return comparable(read_days(spark, out))


def export_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three micro-batches through an appending connector that fails on the way: in the
    first it dies with half of the rows delivered, in the second when all are."""
    silver = read_table(spark, _silver_table(spark, sf_dir))
    source, path = _table_name("exported"), scratch_path(spark, "exported")
    out, checkpoint = scratch_path(spark, "export"), scratch_path(spark, "export-checkpoint")
    to_target, failures = append_to("parquet", path=out), {0: once.ROW + " % 2 = 0", 1: "true"}

    def deliver(rows: DataFrame, batch_id: int) -> None:
        delivered = failures.pop(batch_id, None)
        to_target(rows.filter(delivered) if delivered else rows, batch_id)
        if delivered:
            raise ConnectionError("the connection is lost")

    writer = once.append_once(scratch_path(spark, "stage"), deliver, lambda s: s.read.parquet(out))
    for step in range(3):
        _append(silver.filter(F.col("event_id").cast("bigint") % 3 == step), source, path)
        fails = step in failures
        for _ in range(2 if fails else 1):
            query = export(spark, source, writer, checkpoint, interval=None)
            try:
                query.awaitTermination()
            except StreamingQueryException:
                if not fails:
                    raise
                fails = False
    return comparable(spark.read.parquet(out).drop(once.BATCH, once.ROW))


def rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts noted from the clean stream's progress over four deliveries."""
    root = scratch_path(spark, "rules")
    ledger = RuleLedger(spark, root)
    spark.streams.addListener(ledger)
    try:
        for query in _delivered(spark, sf_dir, watch="quality")[1]:
            ledger.settle(query)
    finally:
        spark.streams.removeListener(ledger)
    return rule_totals(spark, root)


def silver_stream_in_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four deliveries, ids remembered in state for the watermark's delay and in a
    table of ids for ever."""
    raw, raw_path = _table_name("raw"), scratch_path(spark, "raw")
    root, checkpoint = scratch_path(spark, "tiers"), scratch_path(spark, "tiers-checkpoint")
    sent = feed.messages_in_steps(feed.read_events(spark, sf_dir))
    for step in range(feed.STEPS):
        _append(to_bronze(sent.filter(F.col("step") == step).drop("step")), raw, raw_path)
        stream = refine_in_tiers(spark, raw, checkpoint, root, None, buckets=8, fold_every=3)
        stream.awaitTermination()
    return comparable(read_tiers(spark, root))


def stream_state_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids that the clean stream remembers after each delivery, read from its state."""
    audit, checkpoint = scratch_path(spark, "audit"), scratch_path(spark, "refine-checkpoint")

    def look(step: int) -> None:
        ids = remembered(spark, checkpoint).withColumn("step", F.lit(step))
        ids.write.parquet(f"{audit}/{step}")

    _delivered(spark, sf_dir, checkpoint, look)
    return spark.read.schema("event_id string, step int").parquet(f"{audit}/*")


def gold_catch_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared tables in one go; the daily figures at the end of it."""
    names = {name: _table_name(name) for name in TABLES}
    messages = feed.messages(feed.stream_events(spark, sf_dir))
    catch_up(spark, messages, scratch_path(spark, "catch-up"), names)
    return comparable(read_table(spark, names["daily_kpis"]))


QUERIES: dict[str, Query] = {
    "bronze_envelope": bronze_envelope,
    "bronze_record_hash": bronze_record_hash,
    "silver_parse": silver_parse,
    "silver_flags": silver_flags,
    "silver_rules": silver_rules,
    "rule_violation_counts": rule_violation_counts,
    "silver_dedup_before": silver_dedup_before,
    "silver_dedup_after": silver_dedup_after,
    "silver_stream": silver_stream,
    "silver_stream_after": silver_stream_after,
    "silver_stream_within_watermark": silver_stream_within_watermark,
    "silver_stream_batches": silver_stream_batches,
    "silver_stream_batches_within": silver_stream_batches_within,
    "late_rows_dropped": late_rows_dropped,
    "customer_risk_summary": customer_risk_summary,
    "merchant_risk_summary": merchant_risk_summary,
    "daily_kpis": daily_kpis,
    "customer_risk_distinct": customer_risk_distinct,
    "suspicious_null_semantics": suspicious_null_semantics,
    "aggregate_functions": aggregate_functions,
    "risk_signals": risk_signals_query,
    "risk_scores": risk_scores,
    "channel_nulling": channel_nulling,
    "message_round_trip": message_round_trip,
    "incremental_replace": incremental_replace,
    "incremental_recompute": incremental_recompute,
    "incremental_apply": incremental_apply,
    "incremental_fold": incremental_fold,
    "high_water_filter": high_water_filter,
    "export_batches": export_batches,
    "export_appended": export_appended,
    "gold_kept_fresh": gold_kept_fresh,
    "gold_by_cells": gold_by_cells,
    "merchants_by_cells": merchants_by_cells,
    "customers_by_cells": customers_by_cells,
    "activity_by_cells": activity_by_cells,
    "activity_in_buckets": activity_in_buckets,
    "activity_by_bitmaps": activity_by_bitmaps,
    "silver_in_sized_files": silver_in_sized_files,
    "view_refresh": view_refresh,
    "gold_catch_up": gold_catch_up,
    "gold_by_touched_days": gold_by_touched_days,
    "export_once": export_once,
    "rule_ledger": rule_ledger,
    "silver_stream_in_tiers": silver_stream_in_tiers,
    "stream_state_audit": stream_state_audit,
}
