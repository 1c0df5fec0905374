"""Field descriptions: how one target column is computed from one source table.

A field is a function from the source frame to a column.  It sees the frame
because some sources name a column differently from version to version (P2).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping as MappingType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.functions import (
    Mapping,
    blank_to_unknown,
    first_existing_column,
    pii_hash,
    prefixed_id,
    recode,
    rescale,
    safe_date,
    text_key,
    threshold_label,
)

Field = Callable[[DataFrame], Column]


def source(*candidates: str, default: str | None = None) -> Field:
    """The first candidate column that exists; else ``default``, if there is one."""

    def column(df: DataFrame) -> Column:
        name = first_existing_column(df, candidates, required=default is None)
        return F.lit(default) if name is None else F.col(name)

    return column


def constant(value: str) -> Field:
    return lambda df: F.lit(value)


def key(*candidates: str) -> Field:
    return lambda df: text_key(source(*candidates)(df))


def event_id(prefix: str, *candidates: str) -> Field:
    return lambda df: prefixed_id(prefix, source(*candidates)(df))


def date(*candidates: str) -> Field:
    return lambda df: safe_date(source(*candidates)(df))


def amount(decimal_type: str, *candidates: str, times: int = 1, divided_by: int = 1) -> Field:
    return lambda df: rescale(
        source(*candidates)(df), decimal_type, times=times, divided_by=divided_by
    )


def label(mapping: Mapping, *candidates: str, default: str | None = None) -> Field:
    return lambda df: mapping(source(*candidates, default=default)(df))


def device(mapping: Mapping, *candidates: str) -> Field:
    """A standard device, or the mapping's default where the source has no device column."""

    def column(df: DataFrame) -> Column:
        name = first_existing_column(df, candidates)
        return F.lit(mapping.default) if name is None else mapping(F.col(name))

    return column


def place(*candidates: str) -> Field:
    return lambda df: blank_to_unknown(first_existing_column(df, candidates))


def hashed(*candidates: str) -> Field:
    return lambda df: pii_hash(source(*candidates)(df))


def recoded(cases: MappingType[str, str], *candidates: str) -> Field:
    return lambda df: recode(source(*candidates)(df), cases)


def graded(threshold: float, *candidates: str, divided_by: int = 1) -> Field:
    """Pass or fail by a threshold on the common scale."""

    def column(df: DataFrame) -> Column:
        value = source(*candidates)(df)
        return threshold_label(value / divided_by if divided_by != 1 else value, threshold)

    return column


def project(df: DataFrame, fields: MappingType[str, Field]) -> DataFrame:
    """One source table as a conformed frame."""
    return df.select(*(field(df).alias(name) for name, field in fields.items()))
