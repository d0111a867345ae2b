"""De-duplication of batches against a plain Python reading of the rule."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from txrisk.operators.dedup import first_arrivals

ROWS = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c", None]),
        st.integers(0, 20),
        st.integers(0, 2),
        st.floats(-5, 5),
        st.integers(0, 3),
    ),
    max_size=40,
    unique_by=lambda r: (r[1], r[2]),
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS)
def test_first_row_of_each_id_by_time_then_partition_then_offset(spark, rows):
    ddl = "event_id string, kafka_offset bigint, kafka_partition int, amount double, kafka_timestamp int"
    df = spark.createDataFrame(rows, ddl).repartition(3)
    want = {}
    for row in sorted(rows, key=lambda r: (r[4], r[2], r[1])):
        want.setdefault(row[0], row)
    got = {r.event_id: tuple(r) for r in first_arrivals(df).collect()}
    assert got == want


def test_the_smaller_offset_of_another_partition_may_have_come_later(spark):
    rows = [("e", 900, 0, 0), ("e", 5, 3, 6)]
    df = spark.createDataFrame(rows, "event_id string, kafka_offset bigint, kafka_partition int, kafka_timestamp int")
    assert [r.kafka_offset for r in first_arrivals(df).collect()] == [900]
