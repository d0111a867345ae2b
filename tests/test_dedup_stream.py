"""De-duplication of streams: late rows, retention, rule placement, hot ids."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from txrisk.operators.dedup import first_arrivals_stream
from txrisk.operators.rules import expect_or_drop

RULES = {"valid_event_id": "event_id IS NOT NULL", "valid_amount": "amount > 0"}


def minutes(spark, rows):
    """Rows of (event_id, amount, minutes after midnight)."""
    df = spark.createDataFrame(rows, "event_id string, amount double, minute double")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    at = F.timestamp_micros(F.unix_micros(start) + (F.col("minute") * 60_000_000).cast("bigint"))
    return df.select("event_id", "amount", at.alias("event_ts"))


def emitted(df):
    """(id, minute) of every row, sorted; minute None for no event time."""
    day = F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    minute = (F.unix_micros("event_ts") - day) / 60_000_000
    return sorted(
        ((r[0], r[1]) for r in df.select("event_id", minute).collect()), key=lambda x: (str(x[0]), x[1] or 0)
    )


def state(progress):
    """State rows at the end, and rows ever evicted, of the operator that owns the ids."""
    last = [p["stateOperators"][0] for p in progress]
    return last[-1]["numRowsTotal"], sum(s["numRowsRemoved"] for s in last)


LATE = [
    [("a", 1.0, 60.0)],
    [("b", 1.0, 61.0)],
    [("late", 1.0, 5.0), ("a", 1.0, 62.0), ("edge", 1.0, 50.0), ("edge2", 1.0, 51.0), ("edge3", 1.0, 50.5)],
    [("d", 1.0, 62.0)],
]
RETENTION = [
    [("a", -1.0, 0.0), ("b", 5.0, 1.0)],
    [("a", 9.0, 2.0), ("b", 5.0, 60.0)],
    [("late", 1.0, 5.0), ("nullts", 1.0, None), ("c", 1.0, 61.0)],
    [("a", 7.0, 200.0), ("nullts", 1.0, None)],
    [("late2", 1.0, 150.0), ("b", 5.0, 201.0), (None, 3.0, 201.0), (None, 4.0, 202.0)],
]


def test_late_rows_are_dropped_by_the_previous_watermark(spark, play):
    out, _ = play(
        [minutes(spark, b) for b in LATE], lambda s: first_arrivals_stream(s)
    )
    assert emitted(out) == [("a", 60), ("b", 61), ("d", 62), ("edge2", 51), ("edge3", 50.5)]


def test_rules_before_keep_the_valid_copy(spark, play):
    out, progress = play(
        [minutes(spark, b) for b in RETENTION],
        lambda s: first_arrivals_stream(expect_or_drop(s, RULES)),
    )
    assert emitted(out) == [
        ("a", 2), ("b", 1), ("c", 61), ("late", 5), ("late2", 150), ("nullts", None),
    ]
    assert state(progress) == (6, 0)


def test_rules_after_lose_the_event_whose_first_copy_is_invalid(spark, play):
    out, progress = play(
        [minutes(spark, b) for b in RETENTION],
        lambda s: expect_or_drop(first_arrivals_stream(s), RULES),
    )
    assert emitted(out) == [("b", 1), ("c", 61), ("late", 5), ("late2", 150), ("nullts", None)]
    assert state(progress) == (7, 0)


def test_within_watermark_forgets_ids(spark, play):
    out, progress = play(
        [minutes(spark, b) for b in RETENTION],
        lambda s: first_arrivals_stream(expect_or_drop(s, RULES), retention="within_watermark"),
    )
    assert emitted(out) == [
        ("a", 2), ("a", 200), ("b", 1), ("b", 201), ("c", 61), ("late", 5), ("late2", 150),
        ("nullts", None), ("nullts", None),
    ]
    assert state(progress) == (2, 7)


@pytest.mark.parametrize("retention", ["forever", "within_watermark"])
def test_a_flood_of_one_id_adds_no_state(spark, play, retention):
    batch = [("hot", 1.0, 1.0)] * 500 + [(f"id{i}", 1.0, 2.0) for i in range(20)]
    later = [("hot", 1.0, 1.0)] * 500 + [("z", 1.0, 30.0)]
    out, progress = play(
        [minutes(spark, batch), minutes(spark, later)],
        lambda s: first_arrivals_stream(s, retention=retention),
    )
    assert len(emitted(out)) == 22
    (owner,) = progress[0]["stateOperators"]
    assert owner["numRowsTotal"] == 21


@pytest.mark.parametrize("retention", ["forever", "within_watermark"])
def test_a_batch_costs_what_it_brings(spark, play, retention):
    """Twelve batches within one delay: one stateful operator, and its time for
    removals does not grow with what it holds."""
    batches = [[(f"id{k}-{i}", 1.0, k / 10) for i in range(2000)] for k in range(12)]
    out, progress = play(
        [minutes(spark, b) for b in batches],
        lambda s: first_arrivals_stream(s, retention=retention),
    )
    assert out.count() == 24_000
    operators = [p["stateOperators"] for p in progress if p["numInputRows"]]
    assert len(operators) == 12 and {len(x) for x in operators} == {1}
    removals = [x[0]["allRemovalsTimeMs"] for x in operators]
    assert max(removals[6:]) <= max(removals[:6]) + 50


def test_of_differing_copies_in_one_batch_the_first_wins(spark, play):
    """Also when they differ in event time, and so would hash apart."""
    first = [(f"id{i}", 1.0, 10.0 + i) for i in range(200)]
    second = [(f"id{i}", 2.0, 5.0 + i / 7) for i in range(200)]
    out, _ = play([minutes(spark, first + second)], lambda s: first_arrivals_stream(s))
    assert [r[0] for r in out.select("amount").collect()] == [1.0] * 200


def test_a_late_copy_does_not_take_the_place_of_one_in_time(spark, play):
    batches = [[("x", 1.0, 100.0)], [("y", 1.0, 101.0)], [("a", 1.0, 5.0), ("a", 2.0, 100.0), ("a", 3.0, 101.0)]]
    for retention in ("forever", "within_watermark"):
        out, _ = play(
            [minutes(spark, b) for b in batches],
            lambda s: first_arrivals_stream(s, retention=retention),
        )
        assert emitted(out) == [("a", 100), ("x", 100), ("y", 101)]


def test_unknown_retention(spark):
    with pytest.raises(ValueError, match="retention"):
        first_arrivals_stream(minutes(spark, LATE[0]), retention="a while")


def test_play_is_ordered(spark, play):
    out, progress = play([minutes(spark, [("a", 1.0, float(i))]) for i in range(3)], lambda s: s)
    assert [p["numInputRows"] for p in progress if p["numInputRows"]] == [1, 1, 1]
    assert out.count() == 3
