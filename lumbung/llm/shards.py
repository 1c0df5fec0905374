"""Training-order materialisation: token sequences in fixed-stride binary shards, in shuffled order.

1. Every task tokenises its documents, ends each with ``end_token``, joins them up
   and cuts the stream into sequences of ``length`` tokens; only the last sequence
   of a task is padded.  A first pass writes the index of the sequences: the number
   of their part, their number in it and their documents.
2. Counts by part give every sequence an index from 0 to n - 1.
3. A keyed Feistel network permutes the index; where the result is not below n it
   is permuted again (cycle-walking), which makes it a permutation of exactly n slots.
4. Slots are range-partitioned: one task writes a run of consecutive shards, each in
   slot order, by Spark's own writer and committer.  The number of tasks follows from
   the bytes to write, not from the number of shards.

A record is ``length`` little-endian 16-bit tokens and one line feed, so its place
is ``slot % per_shard * stride`` in shard ``slot // per_shard``: a reader can start,
stop and resume at any slot without an index.  Tokenising twice costs less than
keeping all tokens a third time, beside the shuffle and the shards.

Defined cases: NULL and empty texts are a lone end token; NULL ids are listed as
NULL; an empty table makes no shard; other columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumbung.llm.spans import Run, column_bytes, mix, slices, span_hashes, sums_by

# ---- fixed values: how the byte-level vocabularies part a text, and their free token
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END_TOKEN = 50256
# ---- end of fixed values

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
ROUNDS = 6


@dataclass(frozen=True)
class Layout:
    length: int = 2048  # tokens of a sequence
    per_shard: int = 4096  # sequences of a shard
    end_token: int = END_TOKEN
    task_bytes: int = 512 << 20  # of records that one task writes, at least one shard
    batch_bytes: int = 4 << 20  # of records that a task unpacks at once

    @property
    def stride(self) -> int:
        return 2 * self.length + 1


class Tokenizer:
    """Byte-level BPE of many texts at once; a word that comes again is tokenised once.

    A blank with no other white space beside it always starts a new piece, so a
    text is parted there and each part is looked up by its hash, blank included.
    New parts are tokenised together and told apart by the blank that their first
    token starts with.
    """

    MOST = 400_000  # remembered parts

    def __init__(self, vocabulary: bytes):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.encoding = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.opens = np.zeros(max(ranks.values()) + 1, bool)
        self.opens[[token for piece, token in ranks.items() if piece[:1] == b" "]] = True
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.begins, self.sizes = (np.zeros(0, t) for t in (np.uint64, np.int64, np.int64))
        self.pool = np.zeros(0, np.uint16)

    def _encode(self, text: bytes) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(text.decode("utf-8", "replace")), np.uint16)

    def _learn(self, text: np.ndarray, hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        """Tokenise the parts with these hashes and remember them."""
        raw = text.tobytes()
        parts = [raw[a:b] for a, b in zip(first.tolist(), last.tolist())]
        plain = np.array([p[:1] == b" " and p.count(b" ") == 1 and not p[-1:].isspace() for p in parts], bool)
        together = self._encode(b"".join(p for p, ok in zip(parts, plain) if ok))
        at = np.flatnonzero(self.opens[together]) if len(together) else np.zeros(0, np.int64)
        sizes = np.zeros(len(parts), np.int64)
        begins = np.zeros(len(parts), np.int64)
        sizes[plain] = np.diff(np.append(at, len(together)))
        begins[plain] = at
        pool, end = [together], len(together)
        for k in np.flatnonzero(~plain):
            tokens = self._encode(parts[k])
            begins[k], sizes[k] = end, len(tokens)
            pool.append(tokens)
            end += len(tokens)
        hashes = np.concatenate([self.hashes, hashes])
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.begins = np.concatenate([self.begins, begins + len(self.pool)])[order]
        self.sizes = np.concatenate([self.sizes, sizes])[order]
        self.pool = np.concatenate([self.pool, *pool])

    def encode(self, run: Run) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begins, sizes, parts of each text): where the tokens of each part stand in ``pool``."""
        first, last, counts = _parts(run)
        if len(first) == 0:
            return first, first, counts
        hashes, at, again = np.unique(span_hashes(run.prefix(), first, last), return_index=True, return_inverse=True)
        if len(self.hashes) > self.MOST:
            self._forget()
        place = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), bool)
        if len(self.hashes):
            new = self.hashes[np.minimum(place, len(self.hashes) - 1)] != hashes
        if new.any():
            self._learn(run.text, hashes[new], first[at[new]], last[at[new]])
        place = np.searchsorted(self.hashes, hashes)
        return self.begins[place][again], self.sizes[place][again], counts

    def tokens(self, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        ends = np.cumsum(sizes)
        return self.pool[np.repeat(begins - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


#: white space of one byte; the first bytes of the longer ones; the last bytes of those of two bytes
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
_LONG = np.zeros(256, bool)
_LONG[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def _parts(run: Run) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans between blanks that have a character other than white space on both sides."""
    text, n = run.text, len(run.text)
    blanks = np.flatnonzero(text == 0x20)
    blanks = blanks[(blanks > 0) & (blanks < n - 1)]
    before, after = text[blanks - 1], text[blanks + 1]
    alone = ~_WHITE[before] & ~_WHITE[after] & ~_LONG[after]
    alone &= ~((text[np.maximum(blanks - 2, 0)] == 0xC2) & ((before == 0x85) | (before == 0xA0)))
    alone &= ~(_LONG[text[np.maximum(blanks - 3, 0)]] & (before >= 0x80))
    inner = np.ones(n + 1, bool)
    inner[run.starts] = False  # a blank that opens or ends a text has nothing on one side
    inner[run.ends] = False
    edges = np.zeros(n + 1, bool)
    edges[blanks[alone & inner[blanks] & inner[blanks + 1]]] = True
    filled = run.ends > run.starts
    edges[run.starts[filled]] = True
    first = np.flatnonzero(edges)
    counts = np.searchsorted(first, run.ends) - np.searchsorted(first, run.starts)
    counts = np.where(filled, counts, 0)
    last = np.empty(len(first), np.int64)
    last[:-1] = first[1:]
    last[np.cumsum(counts)[filled] - 1] = run.ends[filled]
    return first, last, counts


def _streams(batches: Iterator[pa.RecordBatch], tokenizer: Tokenizer):
    """(doc_ids, run of parts) of every slice of the texts: ids, begins, sizes, parts of each text."""
    for batch in batches:
        data, starts, ends = column_bytes(batch.column(1))
        for i, j in slices(starts, ends, 1 << 20):
            yield batch.column(0).slice(i, j - i), *tokenizer.encode(Run(data, starts[i:j], ends[i:j]))


def _token_counts(sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return sums_by(counts, sizes)


def sequence_index(docs: DataFrame, layout: Layout, vocabulary: bytes) -> DataFrame:
    """(part, number, tokens, doc_ids): what each task of ``docs`` cuts its documents into."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # some 100 kB
    id_type = dict(docs.dtypes)["doc_id"]
    schema = f"part int, number long, tokens int, doc_ids array<{id_type}>"

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, length = TaskContext.get().partitionId(), layout.length
        at, number, ids, rows = 0, 0, [], []

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*rows))
            rows.clear()
            types = [pa.int32(), pa.int64(), pa.int32(), pa.list_(id_array)]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["part", "number", "tokens", "doc_ids"]
            )

        id_array = pa.int64()
        for doc_ids, _, sizes, counts in _streams(batches, Tokenizer(shared.value)):
            id_array = doc_ids.type
            for doc_id, tokens in zip(doc_ids.to_pylist(), _token_counts(sizes, counts).tolist()):
                ids.append(doc_id)
                at += tokens + 1
                while at >= length:
                    rows.append((part, number, length, list(ids)))
                    at, number = at - length, number + 1
                    ids[:] = ids[-1:] if at else []
            if len(rows) >= 4096:
                yield batch_of()
        if at:
            rows.append((part, number, at, list(ids)))
        if rows:
            yield batch_of()

    return docs.select("doc_id", "text").mapInArrow(counted, schema)


def sequences_of(docs: DataFrame, layout: Layout, vocabulary: bytes) -> DataFrame:
    """(part, number, payload): the same sequences with their tokens, compressed."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def cut_streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, pack = Tokenizer(shared.value), zstandard.ZstdCompressor(level=3)
        part, number, rest = TaskContext.get().partitionId(), 0, np.zeros(0, np.uint16)
        end = np.uint16(layout.end_token)

        def batch_of(stream: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            rows = stream.reshape(-1, layout.length)
            numbers = np.arange(number, number + len(rows))
            number += len(rows)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(rows), part, np.int32)),
                    pa.array(numbers),
                    pa.array([pack.compress(row.tobytes()) for row in rows], pa.binary()),
                ],
                ["part", "number", "payload"],
            )

        for _, begins, sizes, counts in _streams(batches, tokenizer):
            ends = np.cumsum(_token_counts(sizes, counts))  # an end token goes after each text
            rest = np.concatenate([rest, np.insert(tokenizer.tokens(begins, sizes), ends, end)])
            whole = len(rest) // layout.length * layout.length
            if whole:
                yield batch_of(rest[:whole])
                rest = rest[whole:]
        if len(rest):
            yield batch_of(np.concatenate([rest, np.full(layout.length - len(rest), end)]))

    return docs.select("doc_id", "text").mapInArrow(cut_streams, "part int, number long, payload binary")


def permuted(values: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """A permutation of 0 .. n - 1, fixed by ``key``: balanced Feistel rounds and cycle-walking."""
    half = np.uint64(max(1, (max(1, n - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key % (1 << 63)))
    out = values.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for k in reversed(keys) if inverse else keys:
            if inverse:
                left, right = right ^ (mix(left + k) & mask), left
            else:
                left, right = right, left ^ (mix(right + k) & mask)
        out[todo] = left << half | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def slot_of(index: str, n: int, key: int) -> Column:
    @F.arrow_udf("long")
    def slots(values: pa.Array) -> pa.Array:
        return pa.array(permuted(values.to_numpy(), n, key))

    return slots(F.col(index))


def writing_tasks(shards: int, layout: Layout, least: int) -> int:
    """How many tasks share the shards: as the bytes need, at least ``least``, a whole shard each."""
    whole = max(1, layout.task_bytes // (layout.per_shard * layout.stride))
    return max(1, min(shards, max(least, -(-shards // whole))))


def run_of_shards(shards: int, tasks: int) -> Column:
    """The task of a shard: consecutive shards stay together and runs differ by one shard at most."""
    return F.floor(F.col("shard").cast("long") * tasks / F.lit(shards)).cast("int")


def materialise(
    docs: DataFrame, folder: str, key: int, layout: Layout = Layout(), vocabulary: str = VOCABULARY
) -> DataFrame:
    """Write the shards below ``folder`` and return their index: (slot, shard, offset, tokens, doc_ids).

    ``docs`` is read twice, so it has to be a stored table: sequences are counted
    first and written after, and the shards' sizes are checked against the count.
    """
    spark = docs.sparkSession
    with open(vocabulary, "rb") as file:
        ranks = file.read()
    sequence_index(docs, layout, ranks).write.parquet(f"{folder}/index")
    index = spark.read.parquet(f"{folder}/index")
    total = index.count()
    counts = index.groupBy("part").agg(F.count("*").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each task of the first pass, of which the scheduler holds more than these two numbers
    begins = F.broadcast(counts.withColumn("begin", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n"))

    def placed(sequences: DataFrame) -> DataFrame:
        return (
            sequences.join(begins, "part")
            .withColumn("index", F.col("begin") + F.col("number"))
            .withColumn("slot", slot_of("index", total, key))
            .withColumn("shard", (F.col("slot") / layout.per_shard).cast("int"))
        )

    shards = -(-total // layout.per_shard)
    if shards:
        records = placed(sequences_of(docs, layout, ranks)).select("shard", "slot", "payload")
        tasks = writing_tasks(shards, layout, spark.sparkContext.defaultParallelism)
        records = records.repartitionById(tasks, run_of_shards(shards, tasks)).sortWithinPartitions("shard", "slot")
        with _small_batches(spark, layout):
            records.select(_record("payload"), "shard").write.partitionBy("shard").text(f"{folder}/shards")
        _check_sizes(spark, folder, total, layout)
    return placed(index).select(
        "slot",
        "shard",
        (F.pmod("slot", F.lit(layout.per_shard)) * layout.stride).alias("offset"),
        "tokens",
        "doc_ids",
    )


@contextmanager
def _small_batches(spark: SparkSession, layout: Layout) -> Iterator[None]:
    """Rows of an Arrow batch for this write: at most ``batch_bytes`` of records, however many a task has."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    rows = max(1, layout.batch_bytes // layout.stride)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _shard_files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/shards")


def _check_sizes(spark: SparkSession, folder: str, total: int, layout: Layout) -> None:
    records = F.least(F.lit(layout.per_shard), F.lit(total) - F.col("shard") * layout.per_shard)
    found = _shard_files(spark, folder).agg(
        F.sum("length").alias("bytes"), F.count_if(F.col("length") != records * layout.stride).alias("wrong")
    )
    row = found.first()
    if row["wrong"] or row["bytes"] != total * layout.stride:
        raise RuntimeError(f"{row['wrong']} shards in {folder} are not whole: the documents changed between the passes")


def _record(payload: str) -> Column:
    @F.arrow_udf("binary")
    def unpacked(values: pa.Array) -> pa.Array:
        unpack = zstandard.ZstdDecompressor()
        return pa.array([unpack.decompress(value) for value in values.to_pylist()], pa.binary())

    return unpacked(F.col(payload)).cast("string").alias("value")  # bytes as they are


def read_from(spark: SparkSession, folder: str, slot: int, layout: Layout = Layout()) -> DataFrame:
    """(slot, tokens) of every record from ``slot`` on, in order; earlier shards are not opened."""
    first = slot // layout.per_shard
    files = _shard_files(spark, folder).where(F.col("shard") >= first).select("shard", "content")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                records = np.frombuffer(content, np.uint8).reshape(-1, layout.stride)
                skip = max(0, slot - shard * layout.per_shard)
                tokens = np.ascontiguousarray(records[skip:, :-1]).view(np.uint16).astype(np.int32)
                slots = shard * layout.per_shard + np.arange(skip, len(records))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(slots, pa.int64()),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(tokens) + 1) * layout.length, pa.int32()), pa.array(tokens.ravel())
                        ),
                    ],
                    ["slot", "tokens"],
                )

    return files.mapInArrow(split, "slot long, tokens array<int>").orderBy("slot")
