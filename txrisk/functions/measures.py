"""Aggregate measures of the summaries.

Money arrives as doubles, and a sum of doubles depends on the order in which
tasks finish. One rule holds for every amount, whatever else its group holds: it
is added as a decimal, to ten places below 10**17 and as a whole number below
10**26, which is exact in any order and rounds ties the same way on every run.
NaN, infinities and larger numbers (which count as infinite) make the sum what
they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FINE_BELOW, _WHOLE_BELOW = 1e17, 1e26
MONEY = ["unit_sum", "rest_sum", "whole_sum", "odd_sum", "amounts"]


def money_parts(amount: str) -> dict[str, Column]:
    """Aggregates, named as in :data:`MONEY`, that add up over parts of a group."""
    value, size = F.col(amount), F.abs(F.col(amount))
    fine, whole = size < _FINE_BELOW, (size >= _FINE_BELOW) & (size < _WHOLE_BELOW)
    huge = F.when(F.isnan(value), value).otherwise(F.signum(value) * F.lit(float("inf")))
    exact = F.when(fine, value).cast("decimal(28,10)")
    units = F.floor(exact)
    return {
        "unit_sum": F.sum(units.cast("decimal(38,0)")),
        "rest_sum": F.sum((exact - units).cast("decimal(38,10)")),
        "whole_sum": F.sum(F.when(whole, value).cast("decimal(38,0)")),
        "odd_sum": F.sum(F.when(size >= _WHOLE_BELOW, huge)),
        "amounts": F.count(value),
    }


def add_parts() -> dict[str, Column]:
    """The same aggregates from rows that hold parts; types stay what they are, with room
    for 10**20 amounts of the largest size."""
    return {name: F.sum(name) for name in MONEY}


def _parts(parts: dict[str, Column] | None) -> list[Column]:
    return [(parts or {name: F.col(name) for name in MONEY})[name] for name in MONEY]


def _size(units: Column, rest: Column) -> tuple[Column, Column, Column]:
    """Sign, whole units and remainder below one of the sum of two parts."""
    carried = F.floor(rest)
    units = (units + carried.cast("decimal(28,0)")).cast("decimal(38,0)")
    rest = (rest % F.lit(1).cast("decimal(1,0)")).cast("decimal(12,10)")  # a difference would lose places
    below = units < 0
    borrowed = below & (rest > 0)
    whole = F.when(borrowed, -units - 1).when(below, -units).otherwise(units).cast("decimal(38,0)")
    return F.when(below, -1).otherwise(1), whole, F.when(borrowed, 1 - rest).otherwise(rest).cast("decimal(12,10)")


def money_total(parts: dict[str, Column] | None = None) -> Column:
    """Sum to two decimals, from columns named as the parts or from aggregates."""
    units, rest, whole, odd, _ = _parts(parts)
    sign, size, below_one = _size(units, rest)
    cents = (size + F.round(below_one, 2)).cast("double") * sign
    large = F.coalesce(cents, F.lit(0.0)) + whole.cast("double")
    return F.coalesce(odd, large, cents)


def money_mean(parts: dict[str, Column] | None = None) -> Column:
    """Average to two decimals, ties away from zero.

    A quotient of decimals is rounded at some place, which may make a tie of what is
    none. So hundredths are divided by remainders, which are exact: those of the whole
    units first, then what is left of them together with the part below one.
    """
    units, rest, whole, odd, n = _parts(parts)
    sign, size, below_one = _size(units, rest)
    count = F.nullif(n, F.lit(0)).cast("decimal(20,0)")

    def divided(amount: Column) -> tuple[Column, Column]:
        left = amount % count
        return ((amount - left) / count).cast("decimal(36,0)"), left

    cents, left = divided((size * 100).cast("decimal(38,0)"))
    more, left = divided((left.cast("decimal(20,0)") + below_one * 100).cast("decimal(34,10)"))
    step = F.when(2 * left >= count, 1).otherwise(0)
    exact = (cents + more + step).cast("double") * sign / 100
    fine = (size.cast("double") + below_one.cast("double")) * sign
    large = F.round((F.coalesce(fine, F.lit(0.0)) + whole.cast("double")) / n, 2)
    return F.coalesce(odd / F.nullif(n, F.lit(0)), large, exact)


def total(amount: str) -> Column:
    """Sum to two decimals; null when no amount is given."""
    return money_total(money_parts(amount))


def mean(amount: str) -> Column:
    """Average to two decimals; null when no amount is given."""
    return money_mean(money_parts(amount))


def peak(amount: str) -> Column:
    """Largest amount to two decimals; NaN counts as larger than any number."""
    return F.round(F.max(amount), 2)


def rows() -> Column:
    return F.count(F.lit(1))


def given(column: str) -> Column:
    """Rows with a value: occurrences, not distinct values."""
    return F.count(column)


def distinct(column: str) -> Column:
    return F.count_distinct(column)


def latest(ts: str) -> Column:
    return F.max(ts)


def flagged_or_null(flag: str) -> Column:
    """How many flags are true; null when every flag of the group is null."""
    return F.sum(F.col(flag).cast("int"))


def flagged(flag: str) -> Column:
    """How many flags are true; 0 when every flag of the group is null."""
    return F.count_if(F.col(flag))
