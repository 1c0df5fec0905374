"""Dictionary lookups.

A small dictionary is part of the expression; Catalyst folds it into one
constant map.  A dictionary which is itself a table is joined, and the
optimizer broadcasts it when its statistics say that it is small.
"""

from __future__ import annotations

from collections.abc import Mapping as MappingType
from dataclasses import dataclass, field
from itertools import chain
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OnMiss = Literal["null", "source", "literal"]


@dataclass(frozen=True)
class Mapping:
    """A named dictionary together with its two policies.

    ``normalize`` looks up ``lower(trim(value))``; ``on_miss`` says what an
    unknown value becomes: NULL, the value itself, or ``default``.
    """

    name: str
    entries: MappingType[str, str] = field(repr=False)
    normalize: bool = False
    on_miss: OnMiss = "null"
    default: str | None = None

    def using(self, **changes) -> "Mapping":
        return Mapping(**{**self.__dict__, **changes})

    def __call__(self, value: Column) -> Column:
        return standardize(
            value,
            self.entries,
            normalize=self.normalize,
            on_miss=self.on_miss,
            default=self.default,
        )


def standardize(
    value: Column,
    entries: MappingType,
    *,
    normalize: bool = False,
    on_miss: OnMiss = "null",
    default: str | None = None,
) -> Column:
    """Look ``value`` up in a literal dictionary."""
    key = F.lower(F.trim(value.cast("string"))) if normalize else value
    literals = ", ".join(_sql_literal(item) for item in chain.from_iterable(entries.items()))
    found = F.expr(f"map({literals})")[key]
    return _resolve_miss(found, value, on_miss, default)


def standardize_with_table(
    df: DataFrame,
    column: str,
    mapping: DataFrame,
    *,
    key: str,
    label: str,
    into: str,
    normalize: bool = False,
    on_miss: OnMiss = "null",
    default: str | None = None,
) -> DataFrame:
    """Look a column up in a dictionary which is a table of unique keys.

    No hint is given: below ``spark.sql.autoBroadcastJoinThreshold`` the
    optimizer broadcasts the dictionary, above it the join is shuffled.
    """
    value = F.col(column)
    wanted = F.lower(F.trim(value.cast("string"))) if normalize else value
    dictionary = mapping.select(F.col(key).alias("__key"), F.col(label).alias("__label"))
    joined = df.withColumn("__wanted", wanted).join(
        dictionary, F.col("__wanted") == F.col("__key"), "left"
    )
    resolved = _resolve_miss(F.col("__label"), value, on_miss, default)
    return joined.withColumn(into, resolved).drop("__wanted", "__key", "__label")


def _resolve_miss(
    found: Column, value: Column, on_miss: OnMiss, default: str | None
) -> Column:
    if on_miss == "null":
        return found
    if on_miss == "source":
        return F.coalesce(found, value.cast("string"))
    if on_miss == "literal":
        return F.coalesce(found, F.lit(default))
    raise ValueError(f"unknown on_miss policy: {on_miss!r}")


def _sql_literal(item: str | int) -> str:
    if isinstance(item, int):
        return str(item)
    escaped = item.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
