"""Summaries of the keys of a batch, by which later loads skip batches.

A summary has two small tables.  ``zones``: the least and the greatest first key, by its
leading letters (one zone where there are more than ``MOST_ZONES``).  ``bloom``: a Bloom filter
as rows, one 64-bit word each, made by an aggregation; a key sets ``KEY_BITS`` bits of one word,
and there are about half as many words as keys.

Neither says that a key is there, only that it is not.  So the exact anti join follows, over
the batches that may hold a key of the new one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_ZONES = 64
KEY_BITS = 6
KEYS_PER_WORD = 2
BATCH = "etl_batch_id"


def key_hash(keys: Sequence[str]) -> Column:
    """64 bits of a key; a hash passes over NULLs, so they are told apart by flags."""
    columns = [F.col(k) for k in keys]
    return F.xxhash64(*columns, *(c.isNull() for c in columns))


def _zone(key: str, kind: str) -> Column:
    return F.regexp_extract(key, r"^\D*", 0) if kind == "string" else F.lit("")


def key_zones(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(zone, low, high, nulls, n): at most MOST_ZONES rows; ``zone`` is NULL where all zones are one.

    The keys are read once, and once more where there are too many zones.
    """
    first, kind = keys[0], dict(rows.dtypes)[keys[0]]
    each = (
        rows.groupBy(F.coalesce(_zone(first, kind), F.lit("")).alias("zone"))
        .agg(
            F.min(first).alias("low"),
            F.max(first).alias("high"),
            F.count_if(F.col(first).isNull()).alias("nulls"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    if kind != "string":  # one zone
        return each.coalesce(1)
    zones = each.limit(MOST_ZONES + 1).collect()
    if len(zones) <= MOST_ZONES:
        return rows.sparkSession.createDataFrame(zones, each.schema).coalesce(1)
    return each.agg(
        F.lit(None).cast("string").alias("zone"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("nulls").alias("nulls"),
        F.sum("n").alias("n"),
    )


def word_count(n_keys: int) -> int:
    """A power of two."""
    return 1 << max(0, (max(1, n_keys) // KEYS_PER_WORD - 1).bit_length())


def _bits(hashed: Column) -> Column:
    """A word with the key's bits, of another hash than the one that chooses the word."""
    more = F.xxhash64(hashed, F.lit("bits"))
    bits = F.lit(0).cast("long")
    for k in range(KEY_BITS):
        place = F.shiftrightunsigned(more, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return bits


def _word(hashed: Column, words: Column) -> Column:
    return hashed.bitwiseAND(words - 1)


def key_bloom(rows: DataFrame, keys: Sequence[str], n_keys: int) -> DataFrame:
    """(words, word, bits): the words that are not empty."""
    words = F.lit(word_count(n_keys)).cast("long")
    hashed = rows.select(key_hash(keys).alias("h"))
    return hashed.groupBy(_word(F.col("h"), words).alias("word")).agg(F.bit_or(_bits(F.col("h"))).alias("bits")).select(
        words.alias("words"), "word", "bits"
    )


def batches_in_range(zones: DataFrame, mine: DataFrame) -> DataFrame:
    """(etl_batch_id, words of its filter's size in n) of the batches that a zone of ``mine`` overlaps.

    Both have at most MOST_ZONES rows a batch.
    """
    a, b = zones.alias("a"), F.broadcast(mine.alias("b"))  # MOST_ZONES rows
    same = F.col("a.zone").isNull() | F.col("b.zone").isNull() | (F.col("a.zone") == F.col("b.zone"))
    overlap = (F.col("a.low") <= F.col("b.high")) & (F.col("a.high") >= F.col("b.low"))
    both_null = (F.col("a.nulls") > 0) & (F.col("b.nulls") > 0)
    return a.join(b, same & (F.coalesce(overlap, F.lit(False)) | both_null), "left_semi").select(BATCH).distinct()


def batches_with_keys(bloom: DataFrame, rows: DataFrame, keys: Sequence[str], sizes: Sequence[int]) -> DataFrame:
    """The batches of ``bloom`` (etl_batch_id, words, word, bits) that may hold a key of ``rows``.

    ``sizes`` are the filters' numbers of words, powers of two and hence few.
    """
    words = F.explode(F.array(*(F.lit(n).cast("long") for n in sizes)))
    hashed = rows.select(key_hash(keys).alias("h")).distinct()
    wanted = hashed.withColumn("words", words).select(
        "words", _word(F.col("h"), F.col("words")).alias("word"), _bits(F.col("h")).alias("wanted")
    )
    found = bloom.join(wanted, ["words", "word"]).where(F.col("bits").bitwiseAND(F.col("wanted")) == F.col("wanted"))
    return found.select(BATCH).distinct()
