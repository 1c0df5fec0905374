"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted, each with a cost.  Pieces are taken from
the longest to the shortest: each goes to the open bin with the least room that
holds it (the earliest of several), and where none does, a new bin is opened.  At the
end every bin is downsized to the cheapest permitted length that holds its contents.

Which length is best to open depends on what comes after the piece, not on the piece
alone.  So the corpus is packed once for each permitted length as the preferred one (a
piece that does not fit it opens the next one that holds it) and once by the least cost
per token, and the packing with the least total cost is taken.  Opening only the longest
length, and always the shortest that fits, are among them, so the total is not above
either.  This is cheap, as it is done on counts:

Pieces of one length are interchangeable, so what a piece-by-piece best fit does
follows from the counts of pieces by length alone: bins with the same room are
filled as one group.  The driver therefore packs the histogram, which has at most
``max(lengths)`` entries however many documents there are, and gets runs: so many
pieces of this length go to these bins, at this offset.  Every piece then finds its
run by its length and its rank among the pieces of its length; ranks are made from
counts by (part file, length), so one frequent length is never in one task.

A document longer than the longest permitted length is cut into pieces of that
length and a rest; nothing is dropped.  Defined cases: documents without a word
have no piece and no row; rows that repeat are packed one by one; NULL ids are
kept; an empty table gives an empty result.  The input is (doc_id, size).
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumbung.llm.cluster import cut


@dataclass(frozen=True)
class Bin:
    """A permitted sequence length and what one sequence of it costs.

    The default cost is a charge for each sequence, one for each token and one for each
    pair of tokens, as attention has it: charge and pairs pull towards other lengths.
    """

    length: int
    cost: float


def bins_of(lengths: Sequence[int], charge: float = 64.0, pairs: float = 1 / 8192) -> list[Bin]:
    return [Bin(length, length + charge + pairs * length * length) for length in sorted(set(lengths))]


@dataclass(frozen=True)
class Runs:
    """Pieces ``first`` to ``last`` of a length, ``each`` to a bin, from bin ``bin`` on, at ``offset``."""

    length: np.ndarray
    first: np.ndarray
    last: np.ndarray
    bin: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    groups: np.ndarray  # first bin of every group of equal bins
    capacity: np.ndarray  # of the bins of the group, after downsizing
    content: np.ndarray  # tokens in each bin of the group
    bin_count: int


def total_cost(runs: Runs, bins: Sequence[Bin]) -> float:
    """The cost of all bins after downsizing."""
    cost = {b.length: b.cost for b in bins}
    ends = np.append(runs.groups[1:], runs.bin_count)
    return float(sum(n * cost[c] for n, c in zip((ends - runs.groups).tolist(), runs.capacity.tolist())))


def best_packing(counts: dict[int, int], bins: Sequence[Bin]) -> Runs:
    """The cheapest of the packings that open another length each; the shortest preferred length of equal ones."""
    tried = [pack_histogram(counts, bins, prefer) for prefer in (*sorted(b.length for b in bins), None)]
    return min(tried, key=lambda runs: total_cost(runs, bins))


def pack_histogram(counts: dict[int, int], bins: Sequence[Bin], prefer: int | None = None) -> Runs:
    """Best fit decreasing of ``counts`` (pieces by length), as it would be piece by piece.

    A new bin has the shortest length from ``prefer`` on that holds the piece, without
    ``prefer`` the one with the least cost per token.
    """
    longest = max(b.length for b in bins)
    open_rooms: list[int] = []  # rooms that some open bin has, ascending
    groups: dict[int, list[tuple[int, int, int]]] = {}  # room: (first bin, bins, content)
    runs, closed, next_bin = [], [], 0

    def put(room: int, group: tuple[int, int, int]) -> None:
        if room not in groups:
            bisect.insort(open_rooms, room)
            groups[room] = []
        heapq.heappush(groups[room], group)

    def fill(size: int, left: int, rank: int, room: int, group: tuple[int, int, int]) -> int:
        """Put up to ``left`` pieces into the bins of a group; returns how many."""
        begin, n, content = group
        each = room // size
        used = min(left, each * n)
        full, rest = divmod(used, each)
        if full:
            runs.append((size, rank, rank + full * each, begin, each, content))
            put(room - each * size, (begin, full, content + each * size))
        if rest:
            runs.append((size, rank + full * each, rank + used, begin + full, rest, content))
            put(room - rest * size, (begin + full, 1, content + rest * size))
        untouched = n - full - (rest > 0)
        if untouched:
            put(room, (begin + n - untouched, untouched, content))
        return used

    for size in sorted(counts, reverse=True):
        left, rank = counts[size], 0
        if not 0 < size <= longest:
            raise ValueError(f"a piece of {size} does not fit any bin")
        while left:
            at = bisect.bisect_left(open_rooms, size)
            if at < len(open_rooms):
                room = open_rooms[at]
                group = heapq.heappop(groups[room])
                if not groups[room]:
                    del groups[room], open_rooms[at]
            else:
                fitting = [b for b in bins if b.length >= size]
                if prefer is None:
                    kind = min(fitting, key=lambda b: (b.cost / b.length, b.length))
                else:
                    kind = min((b for b in fitting if b.length >= prefer), key=lambda b: b.length)
                room, opened = kind.length, -(-left // (kind.length // size))
                group = (next_bin, opened, 0)
                next_bin += opened
            used = fill(size, left, rank, room, group)
            left, rank = left - used, rank + used
    for room in open_rooms:
        for begin, n, content in groups[room]:
            kind = min((b for b in bins if b.length >= content), key=lambda b: (b.cost, b.length))
            closed.append((begin, kind.length, content))
    columns = np.array(sorted(runs), np.int64).reshape(-1, 6).T
    ends = np.array(sorted(closed), np.int64).reshape(-1, 3).T
    return Runs(*columns, *ends, next_bin)


def pieces_of(docs: DataFrame, longest: int) -> DataFrame:
    """(doc_id, piece, start, length): every document cut at multiples of ``longest``."""
    parts = F.sequence(F.lit(0).cast("long"), F.ceil(F.col("size") / longest) - 1)
    return (
        docs.where("size > 0")
        .select("doc_id", "size", F.explode(parts).alias("piece"))
        .select(
            "doc_id",
            "piece",
            (F.col("piece") * longest).alias("start"),
            F.least(F.lit(longest).cast("long"), F.col("size") - F.col("piece") * longest).cast("int").alias("length"),
        )
    )


def packed(docs: DataFrame, bins: Sequence[Bin]) -> DataFrame:
    """Every piece of ``docs`` (doc_id, size) with its place.

    (doc_id, piece, start, length, bin_id, capacity, content, place): words
    ``start`` to ``start + length`` of the document stand at ``place`` of a bin
    that holds ``content`` of ``capacity`` tokens.
    """
    # the written pieces keep their part files, so the part a piece stands in and
    # the order there are the same whenever a task is repeated
    pieces = cut(pieces_of(docs, max(b.length for b in bins))).withColumn("part", F.spark_partition_id())
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # a row for each length
    # bounded by the lengths: a bin has few different lengths, and a length splits few groups
    shared = docs.sparkSession.sparkContext.broadcast(
        best_packing({row["length"]: row["n"] for row in histogram}, bins)
    )
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.withColumn("begin", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    inside = Window.partitionBy("part", "length").orderBy("doc_id", "piece")
    ranked = pieces.join(begins, ["part", "length"]).withColumn(
        "rank", F.col("begin") + F.row_number().over(inside) - 1
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _placed(shared.value, batch)

    return ranked.select("doc_id", "piece", "start", "length", "rank").mapInArrow(
        place,
        f"doc_id {dict(docs.dtypes)['doc_id']}, piece long, start long, length int, bin_id long, capacity int,"
        " content int, place int",
    )


def _placed(runs: Runs, batch: pa.RecordBatch) -> pa.RecordBatch:
    length = batch.column(3).to_numpy().astype(np.int64)
    # runs stand by length and rank, so a piece's number among all pieces finds its run
    begins = np.concatenate([[0], np.cumsum(runs.last - runs.first)])[:-1]
    rank = batch.column(4).to_numpy()
    at = np.searchsorted(begins, begins[np.searchsorted(runs.length, length)] + rank, side="right") - 1
    number = rank - runs.first[at]
    bin_id = runs.bin[at] + number // runs.each[at]
    place = runs.offset[at] + number % runs.each[at] * length
    group = np.searchsorted(runs.groups, bin_id, side="right") - 1
    return pa.RecordBatch.from_arrays(
        [
            *batch.columns[:4],
            pa.array(bin_id),
            pa.array(runs.capacity[group].astype(np.int32)),
            pa.array(runs.content[group].astype(np.int32)),
            pa.array(place.astype(np.int32)),
        ],
        ["doc_id", "piece", "start", "length", "bin_id", "capacity", "content", "place"],
    )
