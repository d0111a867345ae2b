"""Raw row to typed and flagged transaction."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions.scalars import is_cross_border, is_high_amount, iso_timestamp
from txrisk.schema import CARRIED, PAYLOAD_DDL

_TOP_LEVEL_COMMA = re.compile(r",\s*(?![^<]*>)")


def fields(*names: str) -> str:
    """DDL of some payload fields: the parser passes over the others."""
    kinds = dict(x.split(maxsplit=1) for x in _TOP_LEVEL_COMMA.split(PAYLOAD_DDL.strip()))
    return ", ".join(f"{name} {kinds[name]}" for name in names)


def parse_payload(
    bronze: DataFrame, ddl: str = PAYLOAD_DDL, carried: list[str] = CARRIED
) -> DataFrame:
    """One column per payload field, then the carried columns.

    Text that is not an object gives nulls, and so does a field of the wrong type
    by itself. The struct is unpacked by a generator because Spark does not push
    later filters below one: pushed into a projection, every rule would parse the
    whole text once more.
    """
    document = F.from_json("raw_json", ddl)
    return bronze.select(F.inline(F.array(document)), *carried)


def to_typed(bronze: DataFrame) -> DataFrame:
    """Parsed rows with a real event time, a processing time and both flags."""
    return parse_payload(bronze).withColumns(
        {
            "event_ts": iso_timestamp("event_ts"),
            "silver_processed_ts": F.current_timestamp(),
            "is_high_amount_txn": is_high_amount(),
            "is_cross_border": is_cross_border(),
        }
    )
