"""Equi-joins that fetch attributes by key.

The right side's key columns are renamed before the join and dropped after it,
so no name is ever ambiguous.

Three ways to run the same lookup:

* ``lookup`` leaves the strategy to the optimizer.  A right side whose
  statistics are below the threshold is broadcast, a bigger one is shuffled,
  and adaptive execution splits a skewed partition.
* ``lookup(bounded(dim), ...)`` broadcasts a side whose size is bounded by what
  it is (a literal table, one row per calendar day, the values of a fixed map).
* ``salted_lookup`` spreads the most frequent keys over several partitions
  itself, for jobs where one key holds a large share of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded(df: DataFrame) -> DataFrame:
    """Mark a frame that cannot grow with the data.  Say why where it is called."""
    return F.broadcast(df)


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str] | Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Fetch columns of ``right`` for the rows of ``left``.

    ``on`` maps left columns to right columns; ``take`` maps right columns to
    their new names.  ``right`` should be unique on its key.
    """
    narrowed, condition, drops = _prepare(left, right, on, take)
    return left.join(narrowed, condition, how).drop(*drops)


def salted_lookup(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str] | Sequence[str],
    how: str = "left",
    *,
    hot_keys: int = 64,
    salts: int | None = None,
    count_in: DataFrame | None = None,
) -> DataFrame:
    """The same as ``lookup``, with the most frequent left keys split up.

    The ``hot_keys`` most frequent keys are found by a pre-aggregated count.
    Any key that holds more than 1/``hot_keys`` of the rows is among them, and
    the list that is broadcast has ``hot_keys`` rows at most.  A hot key is split
    into as many parts as its share of the rows is worth shuffle partitions, so
    that no part exceeds the mean partition; ``salts`` sets another number for
    all of them.  The matching right rows are repeated once per part.  All other
    keys are joined as usual.  Rows with a NULL key match nothing: they are not
    shuffled and get their NULL attributes in place.

    ``count_in`` is a frame with the same keys in which to count them, for
    instance the rows before an earlier lookup, so that the count does not have
    to repeat that lookup.  It only decides which keys are split.
    """
    left_keys, right_keys = list(on), list(on.values())
    names = [f"__hot{i}" for i in range(len(left_keys))]
    counts = (
        (left if count_in is None else count_in)
        .groupBy(*left_keys)
        .agg(F.count(F.lit(1)).alias("__n"))
        .dropna(subset=left_keys)
    )
    if salts is None:
        partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        worth = F.ceil(F.col("__n") * partitions / counts.agg(F.sum("__n")).scalar())
        parts = F.greatest(F.lit(1), worth).cast("int")
    else:
        parts = F.lit(salts)
    hot = (
        counts.orderBy(F.desc("__n"), *left_keys)
        .limit(hot_keys)
        .select(*(F.col(key).alias(name) for key, name in zip(left_keys, names)), parts.alias("__parts"))
    )

    def mark(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        same = [df[key] == F.col(name) for key, name in zip(keys, names)]
        return df.join(F.broadcast(hot), same, "left").drop(*names)

    # the salt depends on the row and on its input partition, both of which a
    # retried task sees again
    own = F.xxhash64(*left.columns) + F.spark_partition_id()
    no_key = reduce(lambda a, b: a | b, (F.col(key).isNull() for key in left_keys))
    salted_left = (
        mark(left.where(~no_key), left_keys)
        .withColumn("__salt", F.coalesce(F.pmod(own, F.col("__parts")).cast("int"), F.lit(0)))
        .drop("__parts")
    )
    every_salt = F.sequence(F.lit(0), F.coalesce(F.col("__parts"), F.lit(1)) - 1)
    wanted = [*dict.fromkeys([*right_keys, *take])]
    salted_right = mark(right.select(*wanted), right_keys).select(
        *wanted, F.explode(every_salt).alias("__salt")
    )
    joined = lookup(salted_left, salted_right, {**on, "__salt": "__salt"}, take, how).drop("__salt")
    if how == "inner":
        return joined
    kinds = {field.name: field.dataType for field in right.schema}
    takes = take if isinstance(take, Mapping) else {name: name for name in take}
    return joined.unionByName(
        left.where(no_key).withColumns({new: F.lit(None).cast(kinds[old]) for old, new in takes.items()})
    )


def _prepare(left, right, on, take):
    takes = take if isinstance(take, Mapping) else {name: name for name in take}
    key_names = {column: f"__key{i}" for i, column in enumerate(on.values())}
    narrowed = right.select(
        *(F.col(column).alias(name) for column, name in key_names.items()),
        *(F.col(column).alias(name) for column, name in takes.items()),
    )
    condition = None
    for left_column, right_column in on.items():
        same = left[left_column] == F.col(key_names[right_column])
        condition = same if condition is None else condition & same
    return narrowed, condition, list(key_names.values())
