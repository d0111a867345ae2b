"""Score or re-score transactions with the risk rules."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions.risk import is_suspicious, only_remote, risk_signals, signal_columns


def score(df: DataFrame) -> DataFrame:
    """Set the risk signals, how many are on, and the suspicion flag.

    Map-only. The count is added up from the rules themselves, which stays in
    generated code, rather than read back out of the map.
    """
    count = reduce(add, [on.cast("bigint") for on in signal_columns().values()])
    return df.withColumns({"risk_signals": risk_signals(), "risk_score_hint": count}).withColumn(
        "is_suspicious_hint", is_suspicious("risk_score_hint")
    )


def hide_unless_remote(df: DataFrame, *columns: str) -> DataFrame:
    """Null the columns (device and address, say) on all but remote transactions."""
    hidden = columns or ("device_id", "ip_address")
    return df.withColumns({name: only_remote(name) for name in hidden})
