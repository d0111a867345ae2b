"""Aggregate measures: exact money, fallbacks, nulls."""

from __future__ import annotations

import math
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txrisk.functions import measures as m
from txrisk.functions.scalars import percentage


def money(spark, amounts, parts=3):
    df = spark.createDataFrame([(a,) for a in amounts], "amount double").repartition(parts)
    row = df.agg(m.total("amount").alias("t"), m.mean("amount").alias("a"), m.peak("amount").alias("p")).first()
    return row.t, row.a, row.p


def half_up(x: Decimal) -> float:
    return float(x.quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_ties_round_up_whatever_the_order(spark):
    assert money(spark, [0.01, 0.02]) == (0.03, 0.02, 0.02)
    assert money(spark, [1.005]) == (1.01, 1.01, 1.01)
    assert money(spark, [-1.005]) == (-1.01, -1.01, -1.01)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-(10**9), 10**9), min_size=1, max_size=30), st.sampled_from([100, 10_000]))
def test_exact_against_decimals(spark, whole, scale):
    amounts = [Decimal(w) / scale for w in whole]
    total, mean, _ = money(spark, [float(a) for a in amounts])
    assert total == half_up(sum(amounts))
    assert mean == half_up(sum(amounts) / len(amounts))


def test_finer_amounts_are_not_rounded_one_by_one(spark):
    total, mean, _ = money(spark, [0.33333] * 1000)
    assert (total, mean) == (333.33, 0.33)


def test_nan_and_infinity_spread(spark):
    total, mean, peak = money(spark, [1.0, math.nan])
    assert math.isnan(total) and math.isnan(mean) and math.isnan(peak)
    assert money(spark, [1.0, math.inf]) == (math.inf, math.inf, math.inf)


def test_large_amounts(spark):
    total, mean, peak = money(spark, [9e14, 9e14, 9e14])
    assert (total, mean, peak) == (2.7e15, 9e14, 9e14)
    assert money(spark, [3e20, 1.0, 3e20])[:2] == (6e20, 2e20)
    assert money(spark, [1e300, 1.0])[0] == math.inf  # no amount of money


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.one_of(
            st.floats(-1e6, 1e6),
            st.floats(-1e25, 1e25),
            st.integers(-(10**8), 10**8).map(lambda x: x / 100),
            st.sampled_from([math.inf, math.nan, 1e200, 0.33333]),
        ),
        min_size=1,
        max_size=40,
    ),
    st.randoms(use_true_random=False),
)
def test_one_result_whatever_the_order_and_the_partitions(spark, amounts, random):
    first = money(spark, amounts, 1)
    random.shuffle(amounts)
    again = money(spark, amounts, 7)
    assert repr(first) == repr(again)


def test_means_are_rounded_once(spark):
    assert money(spark, [0.0149999999, 0.0])[1] == 0.01
    assert money(spark, [0.01] * 2 + [0.0])[1] == 0.01
    assert money(spark, [-0.01, 0.0])[1] == -0.01


def test_means_of_ten_decimals_keep_them_all(spark):
    assert money(spark, [1.0049999999])[:2] == (1.0, 1.0)
    assert money(spark, [-1.0049999999])[:2] == (-1.0, -1.0)
    assert money(spark, [0.0050000001, 0.0049999999])[:2] == (0.01, 0.01)


def by_parts(spark, amounts):
    """Total and mean of parts that are added up in two steps, as kept cells are."""
    rows = [(k % 3, k % 5, a) for k, a in enumerate(amounts)]
    df = spark.createDataFrame(rows, "k int, l int, amount double")
    named = lambda parts: [c.alias(n) for n, c in parts.items()]
    cells = df.groupBy("k", "l").agg(*named(m.money_parts("amount")))
    cells = cells.unionByName(cells.limit(0))
    fewer = cells.groupBy("k").agg(*named(m.add_parts()))
    assert fewer.select(*m.MONEY).dtypes == cells.select(*m.MONEY).dtypes  # can be kept and added to again
    money_ = m.add_parts()
    return tuple(fewer.agg(m.money_total(money_).alias("t"), m.money_mean(money_).alias("a")).first())


@settings(max_examples=6, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.integers(0, 10), st.lists(st.integers(-(10**11), 10**11), min_size=1, max_size=25))
def test_all_places_count_in_one_step_and_in_parts(spark, places, numbers):
    exact = [Decimal(n).scaleb(-places) for n in numbers]
    amounts = [float(x) for x in exact]
    kept = [Decimal(repr(a)).quantize(Decimal(1).scaleb(-10), ROUND_HALF_UP) for a in amounts]
    want = (half_up(sum(kept)), half_up(sum(kept) / len(kept)))
    assert money(spark, amounts)[:2] == want
    assert by_parts(spark, amounts) == want


@settings(max_examples=5, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.floats(-9.9e16, 9.9e16), st.floats(-9e25, 9e25)), min_size=1, max_size=40))
def test_parts_of_large_amounts_never_overflow(spark, amounts):
    assert repr(by_parts(spark, amounts)) == repr(money(spark, amounts)[:2])


def test_many_large_amounts_in_one_cell(spark):
    amounts = [9.9e16] * 12
    assert by_parts(spark, amounts) == (12 * 9.9e16, 9.9e16) == money(spark, amounts)[:2]


def test_nulls(spark):
    assert money(spark, [None, None]) == (None, None, None)
    assert money(spark, [None, 3.0, 4.0]) == (7.0, 3.5, 4.0)


def test_suspicious_counts_differ_on_all_null(spark):
    df = spark.createDataFrame(
        [(1, True), (1, None), (1, False), (2, None), (2, None), (3, False)], "k int, hint boolean"
    )
    rows = df.groupBy("k").agg(m.flagged_or_null("hint"), m.flagged("hint")).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, 1, 1), (2, None, 0), (3, 0, 0)]


def test_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    assert tuple(df.agg(m.rows(), m.given("x"), m.distinct("x")).first()) == (4, 3, 2)


def test_percentage(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (1, 8), (0, 5), (None, 5)], "s bigint, n bigint")
    share = percentage(F.col("s"), F.col("n"))
    assert df.select(share).schema[0].dataType.typeName() == "double"
    assert [r[0] for r in df.select(share).collect()] == [33.33, 66.67, 12.5, 0.0, None]
