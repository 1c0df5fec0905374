"""Set operations over conformed frames."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Bag union, matched by column name."""
    return reduce(DataFrame.unionByName, frames)


def stack_values(columns: Iterable[tuple[DataFrame, str]], into: str) -> DataFrame:
    """One column from several frames, without NULLs, duplicates kept."""
    return union_all(
        df.where(F.col(name).isNotNull()).select(F.col(name).alias(into)) for df, name in columns
    )


def distinct_values(columns: Iterable[tuple[DataFrame, str]], into: str) -> DataFrame:
    """The different values of one column over several frames.

    The partial aggregation keeps one row per value and task, so the shuffle
    carries values and not rows.
    """
    return stack_values(columns, into).distinct()
