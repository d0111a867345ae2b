"""Fingerprint, typing, flag and default expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txrisk.schema import HASH_SEPARATOR

# --- Fixed values -------------------------------------------------------------
HIGH_AMOUNT_FROM = 1000
HOME_COUNTRY = "US"
BEGINNING_OF_TIME = "1900-01-01"
# ------------------------------------------------------------------------------


def record_hash(*parts: str | Column) -> Column:
    """SHA-256 hex of the parts joined by the separator, null parts left out.

    Not injective: (null, "a||b") and ("a", "b") share a hash.
    """
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), 256)


def iso_timestamp(text: str | Column) -> Column:
    """ISO-8601 text to a timestamp; unreadable text gives null, not an error."""
    text = F.col(text) if isinstance(text, str) else text
    return F.try_to_timestamp(text)


def holds(predicate: Column) -> Column:
    """A predicate that is false where SQL would say unknown."""
    return F.coalesce(predicate, F.lit(False))


def is_high_amount(amount: str = "amount") -> Column:
    return holds(F.col(amount) >= HIGH_AMOUNT_FROM)


def is_cross_border(country: str = "country") -> Column:
    return holds(F.col(country) != HOME_COUNTRY)


def high_water(ts: str) -> Column:
    """Aggregate: newest timestamp, or the beginning of time for no rows."""
    return F.coalesce(F.max(ts), F.lit(BEGINNING_OF_TIME).cast("timestamp"))


def percentage(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, two decimals; null part gives null."""
    return F.round(F.lit(100.0) * part / whole, 2)
