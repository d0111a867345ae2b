"""Named data-quality rules."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from txrisk.functions.scalars import holds

# The rules of the clean transaction table.
SILVER_RULES = {
    "valid_event_id": "event_id IS NOT NULL",
    "valid_transaction_id": "transaction_id IS NOT NULL",
    "valid_amount": "amount > 0",
}


def _checks(rules: dict[str, str]) -> dict[str, Column]:
    return {name: holds(F.expr(predicate)) for name, predicate in rules.items()}


def expect_or_drop(df: DataFrame, rules: dict[str, str] = SILVER_RULES) -> DataFrame:
    """Keep rows that pass every rule; an unknown outcome is a failure.

    A filter drops unknowns by itself, and plain predicates can reach a scan.
    """
    return df.filter(reduce(and_, map(F.expr, rules.values()), F.lit(True)))


def rule_counts(df: DataFrame, rules: dict[str, str] = SILVER_RULES) -> DataFrame:
    """One row per rule: ``rule, passed, failed``. One scan counts all rules."""
    checks = _checks(rules)
    counted = df.agg(
        *[F.count_if(ok).alias(f"{name}.passed") for name, ok in checks.items()],
        *[F.count_if(~ok).alias(f"{name}.failed") for name, ok in checks.items()],
    )
    per_rule = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col(f"`{name}.passed`").alias("passed"),
            F.col(f"`{name}.failed`").alias("failed"),
        )
        for name in checks
    ]
    return counted.select(F.inline(F.array(*per_rule)))


def watch_rules(
    df: DataFrame, name: str | Observation = "rules", rules: dict[str, str] = SILVER_RULES
) -> DataFrame:
    """Report failures per rule with each micro-batch's progress (or as a batch
    observation) without another pass over the rows."""
    failures = [F.count_if(~ok).alias(rule) for rule, ok in _checks(rules).items()]
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *failures)
