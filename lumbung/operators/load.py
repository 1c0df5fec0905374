"""Load policies as DataFrame operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.operators.dedup import dedup_by_key

def new_batch_id(at: dt.datetime | None = None) -> str:
    """L3: ``BATCH-YYYYmmdd-HHMMSS``."""
    return (at or dt.datetime.now()).strftime("BATCH-%Y%m%d-%H%M%S")


def audit_columns(df: DataFrame, batch_id: str) -> DataFrame:
    """L2: when and by which batch a row was loaded."""
    return df.withColumns(
        {"etl_loaded_at": F.current_timestamp(), "etl_batch_id": F.lit(batch_id)}
    )


def new_rows(
    incoming: DataFrame,
    existing: DataFrame | None,
    keys: Sequence[str],
    *,
    null_safe: bool = False,
    once_per_batch: bool = False,
) -> DataFrame:
    """The incoming rows whose key is not in ``existing`` (insert only).

    With ``null_safe`` two NULL key parts are equal, so a row with an unresolved
    key is not loaded again by the next batch.  Equal keys inside one batch
    are all kept, unless ``once_per_batch`` asks for the least row of each.

    Only the key columns of the history are read.  They are first cut down to
    the keys of this batch by a semi join: a batch that is small against the
    history is broadcast there (the optimizer decides by its size), so the long
    history is neither shuffled nor sorted.  Both key lists are made distinct,
    with a partial aggregation first, so a key with very many rows is one row.
    """
    if once_per_batch:
        incoming = dedup_by_key(incoming, keys)
    if existing is None:
        return incoming
    history_names = [f"__old{i}" for i in range(len(keys))]
    batch_names = [f"__new{i}" for i in range(len(keys))]
    history = existing.select(*(F.col(k).alias(n) for k, n in zip(keys, history_names)))
    batch = incoming.select(*(F.col(k).alias(n) for k, n in zip(keys, batch_names))).distinct()
    seen = history.join(
        batch, _same(history_names, batch_names, null_safe), "left_semi"
    ).distinct()
    return incoming.join(seen, _same(keys, history_names, null_safe), "left_anti")


def _same(left: Sequence[str], right: Sequence[str], null_safe: bool):
    pairs = (
        F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b)
        for a, b in zip(left, right)
    )
    return reduce(lambda a, b: a & b, pairs)
