"""Quality gates and the report of what they reject."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named condition.  A row passes only where the condition is true."""

    reason: str
    condition: Column


def required(column: str) -> Rule:
    """P14/P15."""
    return Rule(f"{column} is missing", F.col(column).isNotNull())


def not_after(column: str, as_of: dt.date | None) -> Rule:
    """No date after ``as_of``, and no missing date.

    ``None`` means today; a fixed day makes the result repeatable.
    """
    limit = F.current_date() if as_of is None else F.lit(as_of)
    return Rule(f"{column} is missing or in the future", F.col(column) <= limit)


def within(column: str, low, high) -> Rule:
    """P13."""
    return Rule(f"{column} is out of range", F.col(column).between(low, high))


def at_least(column: str, low) -> Rule:
    """P13."""
    return Rule(f"{column} is out of range", F.col(column) >= F.lit(low))


def quality_gate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows that pass every rule, as one filter the optimizer can push down."""
    return df.where(reduce(lambda a, b: a & b, (rule.condition for rule in rules)))


def tag_rejects(df: DataFrame, rules: Sequence[Rule], into: str = "reject_reason") -> DataFrame:
    """Every row with the first rule it breaks, or NULL."""
    reason = F.lit(None).cast("string")
    for rule in reversed(rules):
        broken = ~F.coalesce(rule.condition, F.lit(False))
        reason = F.when(broken, F.lit(rule.reason)).otherwise(reason)
    return df.withColumn(into, reason)


def reject_report(
    df: DataFrame, rules: Sequence[Rule], by: Sequence[str] = (), rows: str | None = None
) -> DataFrame:
    """Q9: how many rows each rule drops.  ``n_rows`` of a reason counts a row once.

    ``rows`` names the number of rows that a row of ``df`` stands for.
    """
    n_rows = F.count(F.lit(1)) if rows is None else F.sum(rows)
    return (
        tag_rejects(df, rules)
        .where(F.col("reject_reason").isNotNull())
        .groupBy(*by, "reject_reason")
        .agg(n_rows.alias("n_rows"))
    )
