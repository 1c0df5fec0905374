"""Fact builder (X1-X5): key lookups, measures and flags over one event table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.functions.identity import KeyKind, surrogate_key
from lumbung.operators.lookup import bounded, lookup, salted_lookup


@dataclass(frozen=True)
class KeyLookup:
    """Fetch ``key`` from ``dimension`` where its ``natural`` equals ``column``.

    ``size_bounded`` marks dimensions that cannot grow with the data; they are
    broadcast.  For the others the optimizer decides by size.  ``always_there``
    marks natural keys that the dimension holds by construction, so that their
    surrogate key is computed in place of a join.
    """

    dimension: str
    key: str
    column: str
    natural: str
    size_bounded: bool = False
    always_there: bool = False


@dataclass(frozen=True)
class Flag:
    """An expression over the event row, stored under ``name``."""

    name: str
    expression: Column


def build_fact(
    events: DataFrame,
    dimensions: Mapping[str, DataFrame],
    lookups: Sequence[KeyLookup],
    columns: Sequence[Flag],
    *,
    hot_keys: int = 0,
    salts: int | None = None,
    computed_keys: KeyKind | None = "md5_60",
) -> DataFrame:
    """One fact row per event.

    A surrogate key is a function of the natural key.  Where the dimension holds
    the natural key by construction the key is computed and no row moves; an
    event whose entity has left the dimension since gets a key that is not in it,
    which ``orphan_keys`` reports.  Other keys are looked up, and one that is not
    in its dimension is NULL.  ``computed_keys=None`` looks up all of them.

    Measures and flags are computed before the joins, so the rows that are
    shuffled for a big dimension are as narrow as the fact itself.
    ``hot_keys`` > 0 salts the shuffled lookups (see ``salted_lookup``).
    """
    computed = [item for item in lookups if computed_keys and item.always_there]
    looked_up = [item for item in lookups if item not in computed]
    natural = dict.fromkeys(item.column for item in looked_up)
    rows = events.select(
        *(F.col(column).alias(f"__{column}") for column in natural),
        *(surrogate_key(F.col(item.column), computed_keys).alias(item.key) for item in computed),
        *(item.expression.alias(item.name) for item in columns),
    )
    given = rows
    # broadcast lookups first: they do not move rows
    for item in sorted(looked_up, key=lambda item: not item.size_bounded):
        dimension = dimensions[item.dimension]
        on, take = {f"__{item.column}": item.natural}, [item.key]
        if item.size_bounded:
            rows = lookup(rows, bounded(dimension), on, take)
        elif hot_keys:
            rows = salted_lookup(
                rows, dimension, on, take, hot_keys=hot_keys, salts=salts, count_in=given
            )
        else:
            rows = lookup(rows, dimension, on, take)
    return rows.select(
        *(item.key for item in lookups), *(item.name for item in columns)
    )
