"""SimHash near-duplicates through an inverted index of positional bytes.

A fingerprint has 64 bits: a bit is set if it is set in over half of the XXH64
hashes of a text's word shingles.  Two fingerprints that differ in at most ``d``
bits share at least ``8 - d`` of their eight bytes, each at its own position.
The index holds every distinct fingerprint under sets of positional bytes chosen
so that such a pair meets in one of them: of the two halves of the fingerprint one
has at most ``d // 2`` differing bytes, so all sets of ``4 - d // 2`` bytes of
either half are enough.  Pairs that meet are tallied: those that share the
guaranteed number of positional bytes are kept and verified by their bit distance.

An index entry with more than ``MOST`` fingerprints is refined: its pairs must
share more bytes among the remaining positions, so it is split by all sets of
them.  A refined entry fixes all but ``d`` bytes, so its size is bounded by
2^(8 d) whatever the corpus; a large one is searched by bit masks.  Each entry
returns a spanning star of every linked group and never its pairs; copies of a
text are one fingerprint.

Defined cases: NULL and wordless texts have fingerprint zero and link like any
other; texts with fewer words than a shingle hash the whole word sequence; rows
with the same id are separate documents; a component without any id has a NULL
component_id.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from lumbung.llm.cluster import components, cut
from lumbung.llm.spans import column_bytes

SEED = 42
#: fingerprints that one index entry may hold before it is refined
MOST = 2048
PIECE = 1 << 15  # hashes whose bits are counted at once


def fingerprint_of(text: bytes, shingle: int) -> int:
    words = text.lower().split()  # bytes: A-Z only, and apart at 0x20 and 0x09-0x0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = (ends - [len(word) for word in words]).tolist()
    ends = ends.tolist()
    if len(words) < shingle:
        spans = [(0, len(joined))]
    else:
        spans = zip(starts, ends[shingle - 1 :])
    hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in spans], np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), PIECE):
        bits = np.unpackbits(hashes[k : k + PIECE].view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(shingle: int, text: str = "text") -> Column:
    """The fingerprint of a text column, as a signed long with the same bits."""

    @F.arrow_udf("long")
    def fingerprints(texts: pa.Array) -> pa.Array:
        data, starts, ends = column_bytes(texts)
        found = [fingerprint_of(data[a:b].tobytes(), shingle) for a, b in zip(starts.tolist(), ends.tolist())]
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return fingerprints.asNondeterministic()(F.coalesce(F.col(text), F.lit("")))


def as_hex(value: str) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def _byte(position: int) -> Column:
    return F.shiftrightunsigned("fp", 8 * position).bitwiseAND(F.lit(255).cast("long"))


def _key(tag: int, positions: tuple[int, ...]) -> Column:
    key = F.lit(tag).cast("long")
    for position in positions:
        key = F.shiftleft(key, 8).bitwiseOR(_byte(position))
    return key


def first_sets(distance: int) -> list[tuple[int, ...]]:
    """Of any ``8 - distance`` shared positions, at least one of these sets is a part."""
    size = 4 - distance // 2
    return [c for half in (range(4), range(4, 8)) for c in itertools.combinations(half, size)]


def refined_sets(positions: tuple[int, ...], distance: int) -> list[tuple[int, ...]]:
    rest = [p for p in range(8) if p not in positions]
    return [positions + c for c in itertools.combinations(rest, 8 - distance - len(positions))]


def fingerprint_links(fingerprints: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) that connect every group of the distinct ``fp``; not all pairs of a group."""
    if not 0 <= distance <= 5:  # beyond it the keys are too short to be an index
        raise ValueError("the bit distance has to be between 0 and 5")
    sets = first_sets(distance)
    entries = fingerprints.select(
        "fp", F.explode(F.array(*(_key(n, c) for n, c in enumerate(sets)))).alias("key")
    )
    met = entries.groupBy("key").count().where("count > 1")
    entries = cut(entries.join(met, "key"))
    links = _linked(entries.where(F.col("count") <= MOST).select("key", "fp"), distance)
    crowded = entries.where(F.col("count") > MOST)
    tag = F.shiftrightunsigned("key", 8 * len(sets[0]))
    finer = [
        F.when(tag == n, F.array(*(_key(n << 6 | k, c) for k, c in enumerate(refined_sets(positions, distance)))))
        for n, positions in enumerate(sets)
    ]
    refined = crowded.select("fp", F.explode(F.coalesce(*finer)).alias("key"))
    return links.union(_linked(refined, distance)).distinct()


def _linked(entries: DataFrame, distance: int) -> DataFrame:
    n = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        entries.repartition(n, "key")
        .sortWithinPartitions("key", "fp")
        .select("key", "fp")
        .mapInArrow(lambda batches: _link_entries(batches, distance), "a long, b long")
    )


def _link_entries(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    keys, prints = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            prints = np.concatenate([prints, batch.column(1).to_numpy()])
            whole = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last entry may go on
        else:
            whole = len(keys)
        if whole:
            a, b = link_sorted(keys[:whole], prints[:whole], distance)
            keys, prints = keys[whole:], prints[whole:]
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def link_sorted(keys: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A star for each linked group of fingerprints under one key."""
    value = prints.view(np.uint64)
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.concatenate([begins, [len(keys)]]))
    left, right = [], []
    size_of = np.repeat(sizes, sizes)
    here = np.flatnonzero(size_of <= 2 * MOST)
    step = 0
    while len(here):
        step += 1
        here = here[here + step < len(keys)]
        here = here[keys[here] == keys[here + step]]
        apart = value[here] ^ value[here + step]
        shared = (apart.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        near = np.flatnonzero(shared >= 8 - distance)
        near = near[np.bitwise_count(apart[near]) <= distance]
        left.append(here[near])
        right.append(here[near] + step)
    for begin, size in zip(begins[sizes > 2 * MOST], sizes[sizes > 2 * MOST]):
        a, b = _by_masks(np.unique(value[begin : begin + size]), distance)
        order = np.argsort(value[begin : begin + size], kind="stable")
        left.append(begin + order[a])
        right.append(begin + order[b])
    i = np.concatenate(left) if left else np.zeros(0, np.int64)
    j = np.concatenate(right) if right else np.zeros(0, np.int64)
    label = np.arange(len(keys))
    while len(i):
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], least)
        np.minimum.at(new, label[j], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(keys)))
    a, b = prints[moved], prints[label[moved]]
    return a[a != b], b[a != b]


def _by_masks(value: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of distinct sorted fingerprints that agree in all but ``distance`` bytes."""
    varied = [k for k in range(64) if ((value >> np.uint64(k)) & np.uint64(1)).any()
              and not ((value >> np.uint64(k)) & np.uint64(1)).all()]
    left, right = [], []
    for n in range(1, distance + 1):
        for bits in itertools.combinations(varied, n):
            other = value ^ np.uint64(sum(1 << k for k in bits))
            at = np.minimum(np.searchsorted(value, other), len(value) - 1)
            found = np.flatnonzero((value[at] == other) & (other > value))
            left.append(found)
            right.append(at[found])
    none = [np.zeros(0, np.int64)]
    return np.concatenate(left or none), np.concatenate(right or none)


def _rooted(distinct: DataFrame, distance: int) -> DataFrame:
    """``distinct``, one row for each ``fp``, with the root of its component."""
    roots = components(fingerprint_links(distinct.select("fp"), distance))
    return cut(
        distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
            *distinct.columns, F.coalesce("root", "fp").alias("root")
        )
    )


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """(doc_id, fp, root, component_id) of every row of ``docs`` (doc_id, text).

    ``root`` names the component by one of its fingerprints, so it is never NULL.
    """
    prints = cut(docs.select("doc_id", fingerprint(shingle).alias("fp")))
    rooted = _rooted(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), distance)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.join(least, "root").select("fp", "root", "component_id"), "fp").select(
        "doc_id", "fp", "root", "component_id"
    )


def one_of_each(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: exactly one of each component, one with the least id.

    Components may share their least id: each keeps a row of its own texts.  Of a
    component's rows that repeat the least id the one with the least hash of all
    columns stays.  Where no row has an id, one row of the least fingerprint stays.

    The row of a fingerprint is chosen before the components are known, and the
    least of them for each root after it, so neither a crowded id nor a crowded
    text meets in one task.
    """
    names, (high, low) = docs.columns, _row_keys(docs)
    prints = cut(docs.select("doc_id", fingerprint(shingle).alias("fp"), high.alias("high"), low.alias("low")))
    nameless = F.col("doc_id").isNull()
    order = F.struct(nameless.alias("nameless"), "doc_id", F.when(nameless, F.col("fp")).alias("fp"), "high", "low")
    first = prints.groupBy("fp").agg(F.min(order).alias("first"))
    kept = _rooted(first, distance).groupBy("root").agg(F.min("first").alias("first"))
    rows = docs.select(F.struct(*(F.col(f"`{name}`") for name in names)).alias("row"), high.alias("high"), low.alias("low"))
    # equal rows: one of each task is left before the shuffle
    once = Window.partitionBy("high", "low").orderBy("high")
    rows = rows.withColumn("n", F.row_number().over(once)).where("n = 1")
    return rows.join(kept.select("first.high", "first.low"), ["high", "low"], "left_semi").select("row.*")


def _row_keys(docs: DataFrame) -> tuple[Column, Column]:
    """Two hashes of all columns, 128 bits; a hash passes over NULLs, so they are told apart by flags."""
    columns = [docs[f"`{name}`"] for name in docs.columns]
    flags = [column.isNull() for column in columns]
    return F.xxhash64(*columns, *flags), F.xxhash64(F.lit(SEED), *columns, *flags)
