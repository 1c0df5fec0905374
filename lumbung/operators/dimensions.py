"""Dimension builders."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.functions.identity import KeyKind, surrogate_key
from lumbung.functions.standardize import standardize
from lumbung.operators.conform import distinct_values


def date_dimension(
    columns: Iterable[tuple[DataFrame, str]],
    month_names: Mapping[int, str],
    key_kind: KeyKind = "md5_60",
) -> DataFrame:
    """One row per day that occurs in any of the given date columns.

    The result has one row per calendar day at most, whatever the data volume.
    """
    day = F.col("tanggal")
    return distinct_values(columns, "tanggal").select(
        surrogate_key(day, key_kind).alias("waktu_key"),
        day,
        F.month(day).alias("bulan"),
        standardize(F.month(day), month_names).alias("nama_bulan"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("kuartal"),
        F.year(day).alias("tahun"),
    )


def value_dimension(
    columns: Iterable[tuple[DataFrame, str]],
    name: str,
    key: str,
    attributes: Mapping[str, Column] | None = None,
    keep: Column | None = None,
    key_kind: KeyKind = "md5_60",
) -> DataFrame:
    """One row per different value, with a key and derived attributes."""
    values = distinct_values(columns, name)
    if keep is not None:
        values = values.where(keep)
    return values.select(
        surrogate_key(F.col(name), key_kind).alias(key),
        name,
        *(expression.alias(alias) for alias, expression in (attributes or {}).items()),
    )
