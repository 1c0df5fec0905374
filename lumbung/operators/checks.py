"""Constraint checks over finished tables (Q10, Q11, Q16, Q17)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def row_count_rule(
    greater: DataFrame, lesser: DataFrame, by: str, names: tuple[str, str]
) -> DataFrame:
    """Q10: per source, whether one table has at least as many rows as another."""
    first, second = names
    left = greater.groupBy(by).agg(F.count(F.lit(1)).alias(first))
    right = lesser.groupBy(by).agg(F.count(F.lit(1)).alias(second))
    counts = left.join(right, by, "full").na.fill(0, [first, second])
    return counts.withColumn("holds", F.col(first) >= F.col(second))


def domain_rule(
    df: DataFrame, column: str, allowed: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Q11: every value that occurs and is not allowed, every allowed one that is absent.

    With ``by`` the set has to be met in each group.  The groups are source
    tags and the allowed set is a literal, so their product is bounded.
    """
    spark = df.sparkSession
    found = df.groupBy(*by, F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    expected = spark.createDataFrame([(value,) for value in allowed], "value string")
    if by:
        groups = df.select(*by).distinct()
        literal = F.explode(F.array(*(F.lit(value) for value in allowed))).alias("value")
        expected = groups.select(*by, literal)
    unexpected = found.where(
        F.col("value").isNull() | ~F.col("value").isin(*allowed)
    ).withColumn("problem", F.lit("not allowed"))
    present = found.where(F.col("value").isNotNull()).select(*by, "value")
    absent = (
        expected.join(present, [*by, "value"], "left_anti")
        .withColumn("n_rows", F.lit(0).cast("bigint"))
        .withColumn("problem", F.lit("absent"))
    )
    return unexpected.unionByName(absent)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Q16: keys that occur more than once, with their number of rows."""
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where(F.col("n_rows") > 1)


def orphan_keys(
    df: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Q17: foreign keys without a parent row, with their number of rows.

    The keys are counted first, so the anti join sees each key once.
    """
    counts = (
        df.where(F.col(foreign_key).isNotNull())
        .groupBy(foreign_key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    parents = parent.select(F.col(parent_key).alias("__parent"))
    return counts.join(parents, F.col(foreign_key) == F.col("__parent"), "left_anti")
