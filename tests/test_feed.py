"""The feed: which messages it makes, and how much it reads for them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalogue import feed, queries


def _events(spark, ids):
    day = dt.datetime(2024, 1, 10)
    rows = [(n, day + dt.timedelta(days=n % 12), n % 7, "click", 1.5, '{"k": %d}' % n) for n in ids]
    return spark.createDataFrame(rows, feed.EVENTS_DDL)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_copies_of_each_event(spark):
    ids = [0, 1, 7, 50, 97, 207, 9700]
    found = feed.transactions(_events(spark, ids)).groupBy("event_id").agg(
        F.sort_array(F.collect_list("copy")).alias("copies")
    )
    assert {int(r.event_id): r.copies for r in found.collect()} == {
        0: [0, 1],
        1: [0],
        7: [0, 3],
        50: [0, 1],
        97: [0, 2],
        207: [0, 3],
        9700: [0, 1],
    }


def test_props_are_read_for_wanted_messages_alone(spark):
    """A plan is read from its top down: what comes first is done last."""
    sent = feed.messages_in_steps(_events(spark, range(10)))
    plan = _plan(sent.filter(F.col("step") == 2))
    assert plan.index("get_json_object") < plan.index("Filter") < plan.index("Generate")
    assert "lambda" not in plan


def test_only_wanted_messages_are_dealt(spark, tmp_path):
    """The delivery is chosen below the shuffle, which deals it by id over all partitions."""
    _events(spark, range(400)).write.parquet(f"{tmp_path}/events.parquet")
    sent = feed.messages_in_steps(feed.read_events(spark, str(tmp_path)))
    wanted = sent.filter(F.col("step") == 2)
    plan = _plan(wanted)
    assert plan.count("Exchange") == 1
    assert plan.index("Exchange hashpartitioning(event_id") < plan.index("Filter") < plan.index("Generate")
    assert wanted.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_steps_hold_every_message_once(spark):
    events = _events(spark, range(400))
    sent = feed.messages_in_steps(events).drop("step")
    parts = [feed.messages_in_steps(events).filter(F.col("step") == n).drop("step") for n in range(feed.STEPS)]
    again = parts[0]
    for part in parts[1:]:
        again = again.unionAll(part)
    assert sent.count() == again.count() > 400
    assert sent.exceptAll(again).isEmpty()


def test_a_growth_reads_its_own_folder(spark, tmp_path):
    _events(spark, range(1, 60)).write.parquet(f"{tmp_path}/events.parquet")
    growths = queries._silver_in_growths(spark, str(tmp_path), 6)
    whole = queries._silver(spark, str(tmp_path))
    assert growths[0].columns == whole.columns
    for n, growth in enumerate(growths):
        ids = [int(r.event_id) for r in growth.select("event_id").collect()]
        assert ids and all(i % 6 == n for i in ids)
        assert "PartitionFilters: [isnotnull(growth" in _plan(growth)
    assert sum(g.count() for g in growths) == whole.count()
