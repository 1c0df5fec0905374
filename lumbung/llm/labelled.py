"""A bounded, repeatable sample of labelled documents, for the operators that learn from labels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PENDING = 1 << 18  # rows that a task gathers before it drops all but the least of each group


def learning_fold(doc_id: str, modulus: int, held_out: int):
    """True for rows outside the held-out fold, crc32(doc_id as text) mod ``modulus`` = ``held_out``."""
    return ~held_out_fold(doc_id, modulus, held_out)


def held_out_fold(doc_id: str, modulus: int, held_out: int):
    """A NULL id has no remainder and counts as not held out."""
    remainder = F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(modulus))
    return F.coalesce(remainder == F.lit(held_out), F.lit(False))


def least_hashes(rows: DataFrame, group: str, hashed: str, most: int) -> DataFrame:
    """(group, hashed) of the ``most`` least distinct hashes of each group, which bounds no group by another.

    Each task sends at most ``most`` hashes of a group, however often its rows repeat.
    """
    kind = rows.schema[group].dataType.simpleString()
    light = rows.select(F.col(group).alias("g"), F.col(hashed).alias("h"))
    least = light.mapInArrow(lambda batches: _least_of_task(batches, most), f"g {kind}, h long").distinct()
    order = Window.partitionBy("g").orderBy("h")
    least = least.withColumn("n", F.row_number().over(order)).where(F.col("n") <= most)
    return least.select(F.col("g").alias(group), F.col("h").alias(hashed))


def _least_of_task(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    names: dict = {}
    codes, hashes, kind, fresh = [], [], None, 0
    for batch in batches:
        coded = batch.column(0).dictionary_encode()
        kind = coded.dictionary.type
        of = np.array([names.setdefault(name, len(names)) for name in coded.dictionary.to_pylist()], np.int64)
        if not len(of):
            continue
        codes.append(of[coded.indices.to_numpy()])
        hashes.append(batch.column(1).to_numpy())
        fresh += batch.num_rows
        if fresh > PENDING:
            code, value = _least(np.concatenate(codes), np.concatenate(hashes), most)
            codes, hashes, fresh = [code], [value], 0
    if codes:
        code, value = _least(np.concatenate(codes), np.concatenate(hashes), most)
        yield pa.RecordBatch.from_arrays([pa.array(list(names), kind).take(pa.array(code)), pa.array(value)], ["g", "h"])


def _least(code: np.ndarray, value: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((value, code))
    code, value = code[order], value[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (value[1:] != value[:-1])
    code, value = code[new], value[new]
    rank = np.arange(len(code)) - np.searchsorted(code, code)
    return code[rank < most], value[rank < most]


def sampled_rows(rows: DataFrame, group: str, most: int) -> DataFrame:
    """Of each non-NULL ``group`` of ``rows`` (group, doc_id, text) the ``most`` rows that come first by hash.

    Rows with the same id and text count once.
    """
    hashed = rows.withColumn("h", F.xxhash64("doc_id", "text"))
    chosen = F.broadcast(least_hashes(hashed, group, "h", most))  # ``most`` of each group
    return hashed.join(chosen, [group, "h"]).dropDuplicates([group, "h"]).select(rows.columns)


def sampled_labels(labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, label) of at most ``per_class`` documents of each of the classes 0 and 1, by hash order.

    A document with rows of both classes has no usable label.
    """
    clean = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("other"))
        .where("label = other")
        .select("doc_id", "label", F.xxhash64("doc_id").alias("h"))
    )
    chosen = F.broadcast(least_hashes(clean, "label", "h", per_class))  # ``per_class`` of each class
    return clean.join(chosen, ["label", "h"]).select("doc_id", "label")


def sampled_texts(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, text, label) of at most ``per_class`` rows of each class, of the documents of ``sampled_labels``.

    Rows with the same id and text count once.  Where documents repeat an id with other
    texts, first the first row of each id by hash is taken, then the second ones and so
    on, so that no id crowds out the others of its class.
    """
    chosen = F.broadcast(sampled_labels(labels, label, per_class))  # bounded by ``per_class``
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").withColumn("h", F.xxhash64("doc_id", "text"))
    of_id = Window.partitionBy("doc_id").orderBy("h")
    of_class = Window.partitionBy("label").orderBy("n", "h", "doc_id")
    light = least_hashes(rows, "doc_id", "h", per_class).withColumn("n", F.row_number().over(of_id))
    light = light.join(chosen, "doc_id").withColumn("k", F.row_number().over(of_class)).where(F.col("k") <= per_class)
    wanted = F.broadcast(light.select("doc_id", "h"))  # ``per_class`` of each class
    return rows.join(wanted, ["doc_id", "h"]).dropDuplicates(["doc_id", "h"]).select("doc_id", "text", "label")
