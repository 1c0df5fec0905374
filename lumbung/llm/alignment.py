"""Alignment of two tokenizations of one text, by an associative monoid of fragments.

Tokenizer A is byte-level BPE, B is BPE over pieces with byte fallback; both encode a
blank and the text.  The byte offsets at which tokens of both end cut their tokens into
groups, and the last tokens of a group are linked.

* A ``Fragment`` is what a byte range of a document knows: an open prefix (tokens that end
  in the range, up to its first common end), closed groups, and an open suffix (tokens
  after its last common end).  A range without a common end is all prefix.  ``compose``
  joins neighbours: the suffix of the left one and the prefix of the right one close a
  group.  It is associative with the empty fragment as unit, and a fragment of a text
  that B does not give back byte for byte absorbs all others.
* A document of one range is aligned in the task that reads it.  A longer one is cut
  into pieces at the first place from each range's begin at which both tokenizers cut
  anyway (a blank between two characters that are no white space), the pieces are dealt
  over all tasks, each is tokenized there and gives a fragment for each byte range it
  reaches into, and rounds of grouping compose ``Ranges.fan`` neighbouring fragments until
  one is left: a tree whose width is a task's work and whose height does not depend on
  the data.  Equal rows of long documents are aligned once and counted.
* Between such places a part of text is tokenized and aligned once in a task and found
  again by its hash.

The byte strings of linked tokens end alike, so one is the end of the other: there are no
more pairs than such ends in the two vocabularies (``most_links``), which bounds the table
of counts, whatever the size of the corpus.

Defined cases: NULL and empty texts, and texts that B does not give back (U+2581 becomes a
blank), have no tokens; the strings of special tokens are plain text; rows that repeat
have a result each, NULL ids too; an empty table gives an empty result.  Only ``doc_id``
and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm.shards import PATTERN, _parts
from lumbung.llm.spans import Run, column_bytes, slices, span_hashes, sums_by

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
BLANK_PIECE = "▁"

#: marks of tokens in a list of groups: a token of A, the last of its group, a token of B, the last of its group
A, LAST_A, B, LAST_B = range(4)
NONE = np.zeros(0, np.uint16)


@dataclass(frozen=True)
class Ranges:
    size: int = 1 << 16  # bytes
    fan: int = 32  # neighbours that one round composes
    longest: int = 1 << 31  # bytes of the longest text that a column can hold

    @property
    def rounds(self) -> int:
        n, rounds = -(-self.longest // self.size), 0
        while n > 1:
            n, rounds = -(-n // self.fan), rounds + 1
        return rounds


@dataclass(frozen=True)
class Vocabularies:
    """The two files, as they are sent to the tasks."""

    byte_bpe: str
    piece_bpe: bytes

    @staticmethod
    def read(byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> Vocabularies:
        with open(byte_bpe, encoding="utf-8") as one, open(piece_bpe, "rb") as two:
            return Vocabularies(one.read(), two.read())

    def token_bytes(self) -> tuple[list[bytes | None], list[bytes | None]]:
        """The bytes of each id of A and of B; None for ids that no text gives."""
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_proto=self.piece_bpe)
        of_b: list[bytes | None] = []
        for k in range(pieces.get_piece_size()):
            piece = pieces.id_to_piece(k)
            if pieces.is_byte(k):
                of_b.append(bytes([int(piece[3:5], 16)]))
            elif pieces.is_control(k) or pieces.is_unknown(k):
                of_b.append(None)
            else:
                of_b.append(piece.replace(BLANK_PIECE, " ").encode())
        vocabulary = json.loads(self.byte_bpe)["model"]["vocab"]
        of_a: list[bytes | None] = [None] * (max(vocabulary.values()) + 1)
        byte_of = byte_characters()
        for token, k in vocabulary.items():
            of_a[k] = bytes(byte_of[c] for c in token)
        return of_a, of_b


def byte_characters() -> dict[str, int]:
    """Byte-level vocabularies write a visible Latin-1 byte as itself and the others as U+0100 onwards."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(0x100 + n): b for n, b in enumerate(hidden)}


def most_links(vocabularies: Vocabularies) -> int:
    """How many pairs of ids can be linked at all: those of which one's bytes end the other's."""
    ids: list[dict[bytes, int]] = []
    for table in vocabularies.token_bytes():
        count: dict[bytes, int] = {}
        for token in filter(None, table):
            count[token] = count.get(token, 0) + 1
        ids.append(count)
    total = 0
    for mine, others, begin in ((ids[0], ids[1], 0), (ids[1], ids[0], 1)):  # equal strings count on one side only
        for token, n in mine.items():
            total += n * sum(others.get(token[k:], 0) for k in range(begin, len(token)))
    return total


def interleaved(a_ids, a_ends, b_ids, b_ends) -> tuple[np.ndarray, np.ndarray]:
    """(ids, marks) of whole groups in order, the A tokens of each before its B tokens.

    Both sides end at one offset.
    """
    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
    of_a, of_b = (np.searchsorted(common, ends) for ends in (a_ends, b_ends))
    last_a, last_b = common[of_a] == a_ends, common[of_b] == b_ends
    order = np.argsort(np.concatenate([2 * of_a, 2 * of_b + 1]), kind="stable")
    marks = np.concatenate([np.where(last_a, LAST_A, A), np.where(last_b, LAST_B, B)]).astype(np.uint8)
    return np.concatenate([a_ids, b_ids])[order].astype(np.uint16), marks[order]


@dataclass(frozen=True)
class Fragment:
    """Tokens of A and B in a byte range.  Without a common end (``cut`` false) all are in the prefix."""

    cut: bool
    prefix_a: np.ndarray
    prefix_b: np.ndarray
    ids: np.ndarray  # the closed groups
    marks: np.ndarray
    suffix_a: np.ndarray
    suffix_b: np.ndarray

    @staticmethod
    def of(a_ids, a_ends, b_ids, b_ends) -> Fragment:
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        if not len(common):
            return Fragment(False, a_ids, b_ids, NONE, NONE.astype(np.uint8), NONE, NONE)
        (a0, a1), (b0, b1) = (np.searchsorted(ends, common[[0, -1]], side="right") for ends in (a_ends, b_ends))
        closed = interleaved(a_ids[a0:a1], a_ends[a0:a1], b_ids[b0:b1], b_ends[b0:b1])
        return Fragment(True, a_ids[:a0], b_ids[:b0], *closed, a_ids[a1:], b_ids[b1:])

    def pack(self) -> bytes:
        parts = (self.prefix_a, self.prefix_b, self.ids, self.suffix_a, self.suffix_b)
        head = np.array([self.cut, *map(len, parts)], np.int64)
        body = b"".join(part.astype(np.uint16).tobytes() for part in parts)
        return zstandard.compress(head.tobytes() + body + self.marks.tobytes(), 1)

    @staticmethod
    def unpack(data: bytes) -> Fragment:
        raw = zstandard.decompress(data)
        cut, *sizes = np.frombuffer(raw, np.int64, 6).tolist()
        stops = np.cumsum(sizes)
        ids = np.frombuffer(raw, np.uint16, int(stops[-1]), 48)
        marks = np.frombuffer(raw, np.uint8, sizes[2], 48 + 2 * int(stops[-1]))
        prefix_a, prefix_b, closed, suffix_a, suffix_b = np.split(ids, stops[:-1])
        return Fragment(bool(cut), prefix_a, prefix_b, closed, marks, suffix_a, suffix_b)


EMPTY = Fragment(False, NONE, NONE, NONE, NONE.astype(np.uint8), NONE, NONE)


def _group(a_ids: np.ndarray, b_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One closed group."""
    marks = np.repeat(np.array([A, B], np.uint8), [len(a_ids), len(b_ids)])
    marks[len(a_ids) - 1], marks[-1] = LAST_A, LAST_B
    return np.concatenate([a_ids, b_ids]), marks


def compose(left: Fragment | None, right: Fragment | None) -> Fragment | None:
    """The fragment of two neighbouring ranges.  None stands for a text without tokens and absorbs the other."""
    return composed([left, right])


def composed(fragments: list[Fragment | None]) -> Fragment | None:
    """``compose`` over a list in order, with each array copied once."""
    if any(f is None for f in fragments):
        return None
    ids, marks = [], []  # closed groups
    open_a, open_b = [NONE], [NONE]  # what is open at the end
    prefix = None  # once there is a common end: what came up to the first one
    for f in fragments:
        open_a.append(f.prefix_a)
        open_b.append(f.prefix_b)
        if not f.cut:
            continue
        group = np.concatenate(open_a), np.concatenate(open_b)
        if prefix is None:
            prefix = group
        else:
            tokens = _group(*group)
            ids.append(tokens[0])
            marks.append(tokens[1])
        ids.append(f.ids)
        marks.append(f.marks)
        open_a, open_b = [f.suffix_a], [f.suffix_b]
    rest = np.concatenate(open_a), np.concatenate(open_b)
    if prefix is None:
        return Fragment(False, *rest, NONE, NONE.astype(np.uint8), NONE, NONE)
    return Fragment(True, *prefix, np.concatenate(ids), np.concatenate(marks), *rest)


def closed_groups(fragment: Fragment) -> tuple[np.ndarray, np.ndarray]:
    """(ids, marks) of the fragment of a whole document: its prefix is its first group, its suffix is empty."""
    first = _group(fragment.prefix_a, fragment.prefix_b)
    return np.concatenate([first[0], fragment.ids]), np.concatenate([first[1], fragment.marks])


def pack_groups(ids: np.ndarray, marks: np.ndarray, pack: zstandard.ZstdCompressor) -> bytes:
    return pack.compress(ids.tobytes() + marks.tobytes())


def unpack_groups(data: bytes, unpack: zstandard.ZstdDecompressor) -> tuple[np.ndarray, np.ndarray]:
    raw = unpack.decompress(data)
    n = len(raw) // 3
    return np.frombuffer(raw, np.uint16, n), np.frombuffer(raw, np.uint8, n, 2 * n)


class Aligner:
    """Groups of many texts at once; a part of text that comes again is tokenized and aligned once.

    A part begins with a blank and reaches up to the next one that stands between two
    characters other than white space.  A's pattern starts a new word there, and no piece
    of B has a blank after another character, so no token of either crosses it.
    """

    MOST = 1_000_000  # remembered parts

    def __init__(self, vocabularies: Vocabularies):
        import sentencepiece
        import tiktoken

        self.of_a, self.of_b = vocabularies.token_bytes()
        model = json.loads(vocabularies.byte_bpe)["model"]
        merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        ranks = [model["vocab"][m.replace(" ", "")] for m in merges]
        if any(x >= y for x, y in zip(ranks, ranks[1:])):
            raise ValueError("the ids of the merged tokens are not in the order of the merges")
        if any(b" " in token.lstrip(b" ") for token in filter(None, self.of_b)):
            raise ValueError("a piece has a blank after another character")
        self.a = tiktoken.Encoding(
            "bytes",
            pat_str=PATTERN,
            mergeable_ranks={token: k for k, token in enumerate(self.of_a) if token},
            special_tokens={},
        )
        self.b = sentencepiece.SentencePieceProcessor(model_proto=vocabularies.piece_bpe)
        self.a_size, self.b_size = (np.array([len(t or b"") for t in table], np.int64) for table in (self.of_a, self.of_b))
        self.opens = np.array([(token or b"")[:1] == b" " for token in self.of_a])
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.begins, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.whole = np.zeros(0, bool)  # B gives the part back byte for byte
        self.ids, self.marks = NONE, NONE.astype(np.uint8)

    def _learn(self, text: np.ndarray, hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        raw = text.tobytes()
        parts = [raw[a:b] for a, b in zip(first.tolist(), last.tolist())]
        # parts whose only blank is at their begin are tokenized by A together and told apart by it
        plain = np.array([p.count(b" ") == 1 and not p[-1:].isspace() for p in parts], bool)
        order = np.argsort(~plain, kind="stable")
        parts, hashes, n = [parts[k] for k in order.tolist()], hashes[order], int(plain.sum())
        a_ids, a_counts = self._tokens_a(parts, n)
        of_b = self.b.encode([p[1:].decode() for p in parts], num_threads=1)  # B adds the blank itself
        b_counts = np.fromiter(map(len, of_b), np.int64, len(of_b))
        b_ids = np.fromiter(chain.from_iterable(of_b), np.int64, int(b_counts.sum()))
        whole = self._given_back(parts, b_ids, b_counts)
        a_ids, b_ids = (ids[np.repeat(whole, counts)] for ids, counts in ((a_ids, a_counts), (b_ids, b_counts)))
        ids, marks = interleaved(a_ids, np.cumsum(self.a_size[a_ids]), b_ids, np.cumsum(self.b_size[b_ids]))
        sizes = np.where(whole, a_counts + b_counts, 0)
        begins = len(self.ids) + np.cumsum(sizes) - sizes
        known = np.concatenate([self.hashes, hashes])
        order = np.argsort(known)
        self.hashes = known[order]
        self.begins = np.concatenate([self.begins, begins])[order]
        self.sizes = np.concatenate([self.sizes, sizes])[order]
        self.whole = np.concatenate([self.whole, whole])[order]
        self.ids, self.marks = np.concatenate([self.ids, ids]), np.concatenate([self.marks, marks])

    def _tokens_a(self, parts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number in each part); the first ``n`` parts are plain."""
        together = np.array(self.a.encode_ordinary(b"".join(parts[:n]).decode()), np.int64)
        begins = np.flatnonzero(self.opens[together]) if n else np.zeros(0, np.int64)
        rest = [np.array(self.a.encode_ordinary(p.decode()), np.int64) for p in parts[n:]]
        counts = [np.diff(np.append(begins, len(together))), np.array([len(ids) for ids in rest], np.int64)]
        return np.concatenate([together, *rest]), np.concatenate(counts)

    def _given_back(self, parts: list[bytes], b_ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Whether the bytes of each part's tokens are those of the part."""
        table = self.of_b
        sizes = sums_by(counts, self.b_size[b_ids])
        whole = sizes == np.fromiter(map(len, parts), np.int64, len(parts))
        if whole.all() and b"".join([table[k] or b"" for k in b_ids.tolist()]) == b"".join(parts):
            return whole
        stops = np.cumsum(counts)
        spans = zip(parts, (stops - counts).tolist(), stops.tolist())
        return np.array([b"".join([table[k] or b"" for k in b_ids[a:b].tolist()]) == p for p, a, b in spans], bool)

    def groups(self, run: Run) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, marks, tokens of each text, whether each text is whole); every text begins with a blank."""
        first, last, counts = _parts(run)
        if not len(first):
            return NONE, NONE.astype(np.uint8), counts, counts > 0
        # a part's length goes into its hash
        found = span_hashes(run.prefix(), first, last) ^ (last - first).astype(np.uint64)
        hashes, at, again = np.unique(found, return_index=True, return_inverse=True)
        if len(self.hashes) > self.MOST:
            self._forget()
        place = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), bool)
        if len(self.hashes):
            new = self.hashes[np.minimum(place, len(self.hashes) - 1)] != hashes
        if new.any():
            self._learn(run.text, hashes[new], first[at[new]], last[at[new]])
        place = np.searchsorted(self.hashes, hashes)[again]
        begins, sizes = self.begins[place], self.sizes[place]
        ends = np.cumsum(sizes)
        take = np.repeat(begins - ends + sizes, sizes) + np.arange(int(ends[-1]))
        broken = sums_by(counts, (~self.whole[place]).astype(np.int64))
        return self.ids[take], self.marks[take], sums_by(counts, sizes), (counts > 0) & (broken == 0)

    def fragments(self, piece: bytes, base: int, size: int) -> Iterator[tuple[int, Fragment | None]]:
        """(byte range, fragment) of a piece that begins at byte ``base`` of its document."""
        data = np.frombuffer(piece, np.uint8)
        ids, marks, _, whole = self.groups(Run(data, np.array([0]), np.array([len(data)])))
        if not whole[0]:
            yield base // size, None
            return
        side = marks >= B
        sides = ((ids[~side], self.a_size), (ids[side], self.b_size))
        (a_ids, a_ends), (b_ids, b_ends) = ((x, base + np.cumsum(table[x])) for x, table in sides)
        for k in range(base // size, (base + len(data) - 1) // size + 1):
            edges = np.array([k * size, (k + 1) * size])
            a0, a1 = np.searchsorted(a_ends, edges, side="right")
            b0, b1 = np.searchsorted(b_ends, edges, side="right")
            yield k, Fragment.of(a_ids[a0:a1], a_ends[a0:a1], b_ids[b0:b1], b_ends[b0:b1])


def _pieces(text: bytes, size: int) -> list[int]:
    """Where the pieces of a text begin: the first place from each range's begin that no token crosses."""
    data = np.frombuffer(text, np.uint8)
    first, _, _ = _parts(Run(data, np.array([0]), np.array([len(data)])))
    wanted = np.searchsorted(first, np.arange(0, len(data), size))
    return np.unique(first[wanted[wanted < len(first)]]).tolist()


def aligned(
    docs: DataFrame, folder: str, vocabularies: Vocabularies | None = None, ranges: Ranges = Ranges()
) -> DataFrame:
    """(doc_id, groups) of every row of ``docs``, stored below ``folder``; ``groups`` is packed, NULL without tokens.

    ``docs`` is read once.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabularies or Vocabularies.read())  # two files of fixed size
    id_type = dict(docs.dtypes)["doc_id"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, pack = Aligner(shared.value), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = pc.binary_join_element_wise(pa.scalar(" "), batch.column(1).cast(pa.string()), pa.scalar(""))
            data, starts, ends = column_bytes(texts)
            for i, j in slices(starts, ends, 4 << 20):
                yield _read_slice(aligner, pack, batch.column(0).slice(i, j - i), data, starts[i:j], ends[i:j], ranges)

    schema = f"doc_id {id_type}, groups binary, text_hash binary, base long, piece binary"
    docs.select("doc_id", "text").mapInArrow(read, schema).write.parquet(f"{folder}/read")
    found = spark.read.parquet(f"{folder}/read")
    _align_pieces(found.where("piece IS NOT NULL"), shared, ranges).write.parquet(f"{folder}/long")
    return found.where("piece IS NULL").select("doc_id", "groups").union(spark.read.parquet(f"{folder}/long"))


def _read_slice(aligner, pack, ids: pa.Array, data, starts, ends, ranges: Ranges) -> pa.RecordBatch:
    """Rows of the texts: short ones with their groups, long ones as pieces."""
    sizes = ends - starts
    long, short = np.flatnonzero(sizes > ranges.size), np.flatnonzero((sizes > 1) & (sizes <= ranges.size))
    row, groups = [np.flatnonzero(sizes <= 1), short], [None] * int((sizes <= 1).sum())
    if len(short):
        tokens, marks, counts, whole = aligner.groups(_gathered(data, starts[short], ends[short]))
        stops = np.cumsum(counts)
        for a, b, ok in zip((stops - counts).tolist(), stops.tolist(), whole.tolist()):
            groups.append(pack_groups(tokens[a:b], marks[a:b], pack) if ok else None)
    none = [None] * len(groups)
    hashes, bases, pieces = list(none), list(none), list(none)
    for k in long.tolist():
        text = data[starts[k] : ends[k]].tobytes()
        begins = _pieces(text, ranges.size)
        key = hashlib.blake2b(text, digest_size=16).digest()
        row.append(np.full(len(begins), k))
        for a, b in zip(begins, [*begins[1:], len(text)]):
            groups.append(None)
            hashes.append(key)
            bases.append(a)
            pieces.append(text[a:b])
    columns = [
        ids.take(pa.array(np.concatenate(row))),
        pa.array(groups, pa.binary()),
        pa.array(hashes, pa.binary()),
        pa.array(bases, pa.int64()),
        pa.array(pieces, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "groups", "text_hash", "base", "piece"])


def _gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Run:
    """The texts one after the other, without those between them."""
    sizes = ends - starts
    stops = np.cumsum(sizes)
    if int(stops[-1]) == int(ends[-1] - starts[0]):
        return Run(data, starts, ends)
    take = np.repeat(starts - stops + sizes, sizes) + np.arange(int(stops[-1]))
    return Run(data[take], stops - sizes, stops)


def _align_pieces(pieces: DataFrame, shared, ranges: Ranges) -> DataFrame:
    """(doc_id, groups) of the documents whose pieces these are."""
    id_type = dict(pieces.dtypes)["doc_id"]
    # rows that repeat have the same pieces, which are brought together before the shuffle
    keys = ["doc_id", "text_hash", "base"]
    each = pieces.groupBy(*keys).agg(F.count("*").alias("copies"), F.first("piece").alias("piece"))
    each = each.repartition(*keys)

    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(shared.value)
        for batch in batches:
            rows, numbers, made = [], [], []
            bases, texts = batch.column("base").to_pylist(), batch.column("piece").to_pylist()
            for k, (base, text) in enumerate(zip(bases, texts)):
                for number, fragment in aligner.fragments(text, base, ranges.size):
                    rows.append(k)
                    numbers.append(number)
                    made.append(fragment and fragment.pack())
            out = batch.select(["doc_id", "text_hash", "copies", "base"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(numbers, pa.int64()), pa.array(made, pa.binary())],
                ["doc_id", "text_hash", "copies", "base", "place", "fragment"],
            )

    schema = f"doc_id {id_type}, text_hash binary, copies long, base long, place long, fragment binary"
    parts = each.select(*keys[:2], "copies", "base", "piece").mapInArrow(tokenized, schema)
    for _ in range(ranges.rounds):
        parts = (
            parts.withColumn("above", F.expr(f"place DIV {ranges.fan}"))
            .groupBy("doc_id", "text_hash", "above")
            .agg(
                F.max("copies").alias("copies"),
                F.min("base").alias("base"),
                # as many as ``fan`` ranges hold, each at most twice: from the piece before and its own
                F.sort_array(F.collect_list(F.struct("place", "base", "fragment"))).alias("parts"),
            )
            .select(
                "doc_id", "text_hash", "copies", "base", F.col("above").alias("place"),
                _composed()(F.col("parts.fragment")).alias("fragment"),
            )
        )
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return parts.select("doc_id", _finished()(F.col("fragment")).alias("groups"), copies.alias("copy")).drop("copy")


def _composed():
    @F.arrow_udf("binary")
    def tree_node(lists: pa.Array) -> pa.Array:
        out = []
        for packed in lists.to_pylist():
            whole = composed([data and Fragment.unpack(data) for data in packed])
            out.append(whole and whole.pack())
        return pa.array(out, pa.binary())

    return tree_node


def _finished():
    @F.arrow_udf("binary")
    def groups(fragments: pa.Array) -> pa.Array:
        pack = zstandard.ZstdCompressor(level=1)
        return pa.array(
            [data and pack_groups(*closed_groups(Fragment.unpack(data)), pack) for data in fragments.to_pylist()],
            pa.binary(),
        )

    return groups


def group_lists(found: DataFrame) -> DataFrame:
    """(doc_id, groups array<struct<a array<int>, b array<int>>>) of ``aligned``, for readers that want the ids."""

    @F.arrow_udf("array<struct<a: array<int>, b: array<int>>>")
    def lists(packed: pa.Array) -> pa.Array:
        unpack = zstandard.ZstdDecompressor()
        kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
        return pa.array([data and _as_lists(*unpack_groups(data, unpack)) for data in packed.to_pylist()], kind)

    return found.select("doc_id", lists(F.col("groups")).alias("groups"))


def _as_lists(ids: np.ndarray, marks: np.ndarray) -> list[dict]:
    stops = np.flatnonzero((marks == LAST_A) | (marks == LAST_B)) + 1
    runs = [run.tolist() for run in np.split(ids, stops[:-1])]
    return [{"a": a, "b": b} for a, b in zip(runs[::2], runs[1::2])]


@dataclass(frozen=True)
class LinkCounts:
    """How often each pair of ids is linked in the corpus; ``pairs`` is sorted, A's id in the upper bits."""

    pairs: np.ndarray
    counts: np.ndarray

    @property
    def best(self) -> np.ndarray:
        """Whether each pair's count is the highest of its id of B."""
        b = (self.pairs & 0xFFFF).astype(np.int64)
        most = np.zeros(1 << 16, np.int64)
        np.maximum.at(most, b, self.counts)
        return self.counts == most[b]


def _links(ids: np.ndarray, marks: np.ndarray) -> np.ndarray:
    return ids[marks == LAST_A].astype(np.int64) << 16 | ids[marks == LAST_B]


def link_counts(found: DataFrame) -> DataFrame:
    """(a, b, count) of every linked pair of ids; each task adds its documents up first."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, total = zstandard.ZstdDecompressor(), (np.zeros(0, np.int64), np.zeros(0, np.int64))
        waiting, size = [], 0

        def add() -> None:
            nonlocal total, size
            pairs, n = np.unique(np.concatenate(waiting), return_counts=True)
            both, at = np.unique(np.concatenate([total[0], pairs]), return_inverse=True)
            total = both, np.bincount(at, np.concatenate([total[1], n])).astype(np.int64)
            waiting.clear()
            size = 0

        for batch in batches:
            for data in batch.column(0):
                if data.is_valid:
                    waiting.append(_links(*unpack_groups(data.as_py(), unpack)))
                    size += len(waiting[-1])
                    if size > 1 << 20:
                        add()
        if waiting:
            add()
        yield pa.RecordBatch.from_arrays([pa.array(total[0]), pa.array(total[1])], ["pair", "n"])

    sums = found.select("groups").mapInArrow(counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("count"))
    return sums.select(
        F.shiftright("pair", 16).cast("int").alias("a"), F.expr("int(pair & 65535)").alias("b"), "count"
    )


def collected_counts(counts: DataFrame, most: int) -> LinkCounts:
    """``counts`` on the driver; ``most`` is the vocabularies' own bound of their number."""
    table = counts.select((F.shiftleft(F.col("a").cast("long"), 16) + F.col("b")).alias("pair"), "count").toArrow()
    if len(table) > most:
        raise RuntimeError(f"{len(table)} linked pairs, where the vocabularies allow {most}")
    pairs, n = (table.column(k).to_numpy().astype(np.int64) for k in range(2))
    order = np.argsort(pairs)
    return LinkCounts(pairs[order], n[order])


class Writer:
    """Groups as text, ``a1,a2|b1;a3|b2,b3``: decimal ids, each followed by one separator."""

    def __init__(self):
        digits = [str(k).encode() for k in range(1 << 16)]
        self.sizes = np.array([len(d) for d in digits], np.int64)
        self.table = np.frombuffer(b"".join(d.ljust(6, b"\0") for d in digits), np.uint8).reshape(-1, 6)
        self.separators = np.frombuffer(b",|,;", np.uint8)  # by mark

    def text(self, ids: np.ndarray, marks: np.ndarray) -> bytes:
        rows, size = self.table[ids], self.sizes[ids]
        rows[np.arange(len(ids)), size] = self.separators[marks]
        return rows[np.arange(6) <= size[:, None]].tobytes()


def digests(found: DataFrame, counts: LinkCounts) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of ``aligned``."""
    shared = found.sparkSession.sparkContext.broadcast(counts)  # bounded by the vocabularies
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")

    @F.arrow_udf(f"struct<{', '.join(f'{n}: long' for n in names)}, groups_sha256: string>")
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table, best, writer = shared.value, shared.value.best, Writer()
        unpack = zstandard.ZstdDecompressor()
        for packed in batches:
            numbers, hashes = np.zeros((len(packed), len(names)), np.int64), [""] * len(packed)
            for k, data in enumerate(packed):
                if not data.is_valid:
                    continue
                ids, marks = unpack_groups(data.as_py(), unpack)
                pairs = _links(ids, marks)
                at = np.searchsorted(table.pairs, pairs)
                n_a = int((marks < B).sum())
                numbers[k] = (
                    n_a, len(ids) - n_a, len(pairs), len(pairs), int(best[at].sum()), int(table.counts[at].sum())
                )
                hashes[k] = _text_hash(writer, ids, marks)
            columns = [pa.array(numbers[:, c]) for c in range(len(names))]
            yield pa.StructArray.from_arrays([*columns, pa.array(hashes, pa.string())], [*names, "groups_sha256"])

    found = found.select("doc_id", digest.asNondeterministic()(F.col("groups")).alias("found"))
    return found.select("doc_id", *(f"found.{name}" for name in names), "found.groups_sha256")


def _text_hash(writer: Writer, ids: np.ndarray, marks: np.ndarray, step: int = 1 << 18) -> str:
    value = hashlib.sha256()
    for at in range(0, len(ids), step):
        text = writer.text(ids[at : at + step], marks[at : at + step])
        value.update(text[:-1] if at + step >= len(ids) else text)
    return value.hexdigest()


def align_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """``digests`` of every row of ``docs`` with the counts of the whole table."""
    vocabularies = Vocabularies.read()
    found = aligned(docs, folder, vocabularies)
    return digests(found, collected_counts(link_counts(found), most_links(vocabularies)))
