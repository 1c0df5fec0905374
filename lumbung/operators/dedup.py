"""Deduplication with a total order (A1, A3, A4).

A plain ``dropDuplicates`` keeps whichever row comes first.  Here the least row
by a stated order is kept, so every run gives the same result.  The filter on
``row_number`` is applied in every task before the shuffle as well (a group
limit in the plan), so a key with very many copies sends one row per task and
never fills one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_by_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """A3/A4: one row per key, the least by ``order_by`` and then by all columns.

    NULL sorts first.  Rows equal in every column are interchangeable.
    """
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.distinct()
    ordered = [*order_by, *(name for name in rest if name not in order_by)]
    least_first = Window.partitionBy(*keys).orderBy(*ordered)
    return df.withColumn("__n", F.row_number().over(least_first)).where("__n = 1").drop("__n")


def pick_per_entity(
    df: DataFrame, entity: str, order_by: Sequence[str], take: Sequence[str]
) -> DataFrame:
    """A1: the attributes of one and the same row for each entity."""
    columns = dict.fromkeys([entity, *order_by, *take])
    return dedup_by_key(df.select(*columns), [entity], order_by).select(entity, *take)
