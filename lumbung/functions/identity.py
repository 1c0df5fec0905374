"""Identity: hashed personal data, global ids and surrogate keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KeyKind = Literal["crc32", "md5_60"]


def pii_hash(column: Column | str) -> Column:
    """md5 of the lower-cased text; NULL stays NULL."""
    value = F.col(column) if isinstance(column, str) else column
    return F.md5(F.lower(value))


def global_id(prefix: str, identity: Column, digits: int = 32) -> Column:
    """An id that depends on the identity alone.

    Equal identities of different sources get equal ids without a distinct, a
    shuffle or a join, and a later run gives the same id again.  All ``digits``
    of the hash are kept; fewer are for short ids of old readers, and merge
    identities beyond some ten thousand (8 digits), so check ``key_collisions``.
    """
    return F.concat(F.lit(prefix), F.upper(F.substring(F.md5(identity), 1, digits)))


def packed_id(prefix: str, value: Column) -> Column:
    """A global id as bytes: its hash digits two to a byte, any other text as it is.

    ``unpacked_id`` gives the text back.  Packed ids sort as their texts do; ids that
    are not of the form of ``global_id`` come after them.
    """
    digits = F.unhex(F.substring(value, len(prefix) + 1, 2**31 - 1))
    as_packed = F.concat(F.lit(bytes([0])), digits)
    as_text = F.concat(F.lit(bytes([1])), F.encode(value, "UTF-8"))
    return F.when(F.concat(F.lit(prefix), F.hex(digits)) == value, as_packed).otherwise(as_text)


def unpacked_id(prefix: str, packed: Column) -> Column:
    """The global id that ``packed_id`` has packed."""
    rest = F.substring(packed, 2, 2**31 - 1)
    is_packed = F.substring(packed, 1, 1) == F.lit(bytes([0]))
    return F.when(is_packed, F.concat(F.lit(prefix), F.hex(rest))).otherwise(F.decode(rest, "UTF-8"))


def surrogate_key(natural: Column, kind: KeyKind = "md5_60") -> Column:
    """I4: a numeric key which is a pure function of the natural key.

    ``md5_60`` has 60 bits.  ``crc32`` has 32: expect about n^2/2^33 collisions,
    that is one near 90 thousand keys, so its users check ``key_collisions``.
    """
    text = natural.cast("string")
    if kind == "crc32":
        return F.crc32(text)
    if kind == "md5_60":
        return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    raise ValueError(f"unknown key kind: {kind!r}")


def collision_report(tables: Mapping[str, tuple[DataFrame, str, Column | str]]) -> DataFrame:
    """I5 over several tables: natural keys, keys and keys that stand for more than one.

    ``tables`` maps a name to (frame, key, natural key).  A NULL key or natural
    key names nothing and is left out.
    """

    def one(name: str, df: DataFrame, key: str, natural: Column | str) -> DataFrame:
        value = F.col(natural) if isinstance(natural, str) else natural
        pairs = df.select(F.col(key).alias("key"), value.cast("string").alias("natural")).dropna().distinct()
        per_key = pairs.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        return per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_natural"),
            F.count(F.lit(1)).alias("n_keys"),
            F.count_if(F.col("n") > 1).alias("n_collisions"),
        ).select(F.lit(name).alias("table_name"), "n_natural", "n_keys", "n_collisions")

    parts = [one(name, *spec) for name, spec in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def key_collisions(df: DataFrame, key: str, natural: Sequence[str]) -> DataFrame:
    """Keys that stand for more than one natural key.

    Distinct pairs first: the second count sees one row per natural key, so
    many copies of one row do not meet in one task.
    """
    pairs = df.select(key, *natural).where(F.col(key).isNotNull()).distinct()
    return (
        pairs.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_natural"))
        .where(F.col("n_natural") > 1)
    )
